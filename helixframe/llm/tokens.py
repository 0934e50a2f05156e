"""Token ids of whole texts, with a memo of words.

Text is cut at ASCII white space, which no token of the vocabulary spans, so a
text's ids are those of its words one after another. Splitting, the search for
different words and the assembly of ids are Arrow kernels over a slice of texts;
only the slice's different words are looked up in Python, and only new ones are
sent to the tokenizer, in batches.
"""

from __future__ import annotations

import os
import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from helixframe.llm.common import slices

#: Bytes that the memo of a Python worker may take, in two generations: words not met during a whole generation are forgotten.
MEMO_BYTES = 48_000_000
#: What an entry of the memo takes besides its word and ids: two objects and a place in a table.
ENTRY_BYTES = 160
#: UTF-8 bytes of the texts whose words are looked up together; a longer text is a slice of its own.
SLICE_BYTES = 4_000_000
#: Words that are encoded as one text.
JOINED = 200
#: ASCII marks that may end a word. After a letter or digit they are tokens of their own.
TAIL = ".,!?;:|#$%&*"


class WordTokens:
    """Ids of texts as unsigned 16-bit numbers; for vocabularies of up to 65,536 ids that are blind to case."""

    def __init__(self, path: str, literal: bool = False):
        """literal: strings of special tokens in a text are ordinary text."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.tokenizer.encode_special_tokens = literal
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("the vocabulary is too large for 16-bit ids")
        if sys.byteorder != "little":
            raise ValueError("ids are kept in the machine's order, which must be little-endian")
        self.ends_word = np.zeros(1 << 16, dtype=bool)
        for token, i in self.tokenizer.get_vocab().items():
            self.ends_word[i] = token.endswith("</w>")
        self.memo: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}
        self.held = 0

    def _of(self, words: pa.Array) -> pa.Array:
        """Ids of different words or marks, as binary."""
        names = words.cast(pa.binary()).to_pylist()
        found = list(map(self.memo.get, names))
        missing = [i for i, ids in enumerate(found) if ids is None]
        fresh: dict[bytes, bytes] = {}
        unknown = []
        for i in missing:
            ids = self.older.get(names[i])
            if ids is None:
                unknown.append(names[i])
            else:
                fresh[names[i]] = ids
        self._encode([w.decode("utf-8", "replace") for w in unknown], unknown, fresh)
        for i in missing:
            found[i] = fresh[names[i]]
        size = sum(map(len, fresh)) + sum(map(len, fresh.values())) + ENTRY_BYTES * len(fresh)
        if self.held + size > MEMO_BYTES // 2:
            self.older, self.memo, self.held = self.memo, {}, 0
        if size <= MEMO_BYTES // 2:
            self.memo.update(fresh)
            self.held += size
        return pa.array(found, pa.binary())

    def _encode(self, words: list[str], names: list[bytes], out: dict[bytes, bytes]) -> None:
        """Adds ids. Words of letters only are encoded many to a text and told apart by their ends of word."""
        plain = [i for i, w in enumerate(words) if w.isalpha()]
        groups = [plain[i : i + JOINED] for i in range(0, len(plain), JOINED)]
        rest = [i for i, w in enumerate(words) if not w.isalpha()]
        for group, e in zip(groups, self.tokenizer.encode_batch_fast([" ".join([words[i] for i in g]) for g in groups], add_special_tokens=False)):
            ids = np.array(e.ids, dtype="<u2")
            cut = (np.flatnonzero(self.ends_word[ids]) * 2 + 2).tolist()
            if len(cut) != len(group):  # a word with more ends of word than one
                rest += group
                continue
            raw, at = ids.tobytes(), 0
            for i, end in zip(group, cut):
                out[names[i]] = raw[at:end]
                at = end
        for k in range(0, len(rest), 5_000):
            some = rest[k : k + 5_000]
            for i, e in zip(some, self.tokenizer.encode_batch_fast([words[i] for i in some], add_special_tokens=False)):
                out[names[i]] = array("H", e.ids).tobytes()

    def _ids(self, words: pa.Array) -> pa.Array:
        """Ids of different words: each is a lower-case core and a tail of marks, unless it may hold a special token."""
        special = pc.match_substring(words, "<|")
        core = pc.ascii_rtrim(words, characters=TAIL)
        cut = pc.and_not(pc.match_substring_regex(core, r"[0-9\p{L}]\z"), special)
        core = pc.if_else(cut, core, words)
        n_tail = pc.subtract(pc.binary_length(words), pc.binary_length(core)).to_numpy()
        core = pc.if_else(special, core, pc.ascii_lower(core))
        coded = core.dictionary_encode()
        ids = self._of(coded.dictionary).take(coded.indices)
        with_tail = np.flatnonzero(n_tail)
        if not len(with_tail):
            return ids
        tails = words.take(pa.array(with_tail))
        sizes = n_tail[with_tail]
        kinds = [(k, np.flatnonzero(sizes == k)) for k in np.unique(sizes).tolist()]
        marks = pa.concat_arrays([pc.utf8_slice_codeunits(tails.take(pa.array(at)), -k) for k, at in kinds])
        coded = marks.dictionary_encode()
        own = self._of(coded.dictionary).take(coded.indices)
        order = np.concatenate([with_tail[at] for _, at in kinds])
        place = np.full(len(words), -1)
        place[order] = np.arange(len(order))
        tail_ids = pc.fill_null(own.take(pa.array(place, mask=place < 0)), b"")
        return pc.binary_join_element_wise(ids, tail_ids, b"")

    def flat(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where each text's start (one more: the end). No nulls in texts."""
        split = pc.ascii_split_whitespace(texts)
        ends = split.offsets.to_numpy()
        words = split.flatten()
        if not len(words):
            return np.empty(0, dtype="<u2"), np.zeros(len(texts) + 1, dtype=np.int64)
        coded = words.dictionary_encode()
        ids = self._ids(coded.dictionary).take(coded.indices)
        _, places, data = ids.buffers()
        at = np.frombuffer(places, dtype="<i4")[ids.offset : ids.offset + len(ids) + 1].astype(np.int64)
        flat = np.frombuffer(data, dtype="<u2")[at[0] // 2 : at[-1] // 2] if data is not None else np.empty(0, dtype="<u2")
        return flat, (at[ends - ends[0]] - at[0]) // 2

    def batch(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text as little-endian 16-bit bytes; null is an empty text."""
        out = []
        for _, some in slices(pa.array(texts, pa.string()), SLICE_BYTES):
            flat, ends = self.flat(some)
            out += [flat[a:b].tobytes() for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        return out


_KEPT: dict[tuple, WordTokens] = {}


def word_tokens(path: str, literal: bool = False) -> WordTokens:
    """One for each Python worker, kept between tasks."""
    if (path, literal) not in _KEPT:
        _KEPT[path, literal] = WordTokens(path, literal)
    return _KEPT[path, literal]


def default_path(name: str = "word_bpe_49k.json") -> str:
    """A file of the public tokenizers on this machine; on a cluster each node has the library."""
    import public_tokenizers

    return public_tokenizers.path(name)
