"""Order-free comparison of two frames."""


def rows(df):
    df = df[sorted(df.columns)].astype(object)
    return sorted(map(repr, df.where(df.notna(), None).itertuples(index=False, name=None)))


def assert_same(got, want):
    assert sorted(got.columns) == sorted(want.columns)
    a, b = rows(got), rows(want)
    assert len(a) == len(b)
    assert [x for x in zip(a, b) if x[0] != x[1]][:3] == []
