"""A line bucket beyond what a task holds gives each line once, however its rows are split."""

import random

import pandas as pd
import pytest

from helixframe.llm import line_dedup


@pytest.mark.parametrize("held,batch", [(2, 1), (3, 4), (5, 3), (8, 7)])
def test_large_buckets_as_small_ones(monkeypatch, held, batch):
    r = random.Random(held)
    rows = []
    for h in range(60):
        for i in r.sample(range(-20, 20), r.choice([1, 1, 2, 3, 9])):
            rows += [(h, i, r.choice([0, 1, 1, 3]))] * r.choice([1, 2, 12])
    rows.sort()
    by = {}
    for h, i, c in rows:
        by.setdefault(h, []).append((i, c))
    live = {h for h, x in by.items() if len({i for i, _ in x}) > 1 and any(c % 2 == 0 for _, c in x)}
    want = sorted({(h, i) for h, i, _ in rows if h in live})
    frames = [pd.DataFrame(rows[k : k + batch], columns=["h", "id", "code"]) for k in range(0, len(rows), batch)]
    monkeypatch.setattr(line_dedup, "HELD", held)
    got = pd.concat(list(line_dedup._live(iter(frames))))
    assert sorted(zip(got["h"], got["id"])) == want
