"""Token ids of whole texts by a public tokenizer file, with words encoded once.

The tokenizer (a ``tokenizers`` JSON file) drops white space between
pre-tokens, so a text's ids are those of its words one after another. Texts are
taken in groups of bounded size: a group is split by Arrow, its distinct words
go to the library, and the ids are dealt out again, word for word. Nothing is
kept from group to group.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from tributary.llm.common import KEPT, groups_of, slices, text_bytes

#: Bytes of text whose distinct words are encoded together.
GROUP_BYTES = 16 << 20
_SUFFIX = b".,!?;:#$%&*|\"()[]{}-_=+/\\@^~`<>"
_WORDS_AT_ONCE = 50
#: Letters below U+0250, which are never pre-tokens of their own; U+0130 lower-cases to a letter and a mark.
_NEAR = r"^[\x{1}-\x{12F}\x{131}-\x{24F}]+$"

_encoders: dict[str, WordIds] = {}
KEPT["wordids"] = _encoders


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def encoder(path: str) -> WordIds:
    """The encoder of this process for a tokenizer file."""
    if path not in _encoders:
        _encoders[path] = WordIds(path)
    return _encoders[path]


class WordIds:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for token, i in vocab.items():
            self.ends[i] = token.endswith("</w>")
        self.special = [t.encode() for t in self.tokenizer.get_added_tokens_decoder().values() for t in [t.content]]

    def ids(self, texts: Iterable[bytes], most: int = GROUP_BYTES) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text, without special tokens added."""
        out: list[list[bytes]] = []
        parts: list[bytes] = []
        owner: list[int] = []
        for text in texts:
            # the tokenizer lower-cases, but it finds its special tokens before that
            low = text if any(s[:2] in text for s in self.special) else text.lower()
            for part in slices(low):
                parts.append(part)
                owner.append(len(out))
            out.append([])
        for i, j in groups_of(parts, most):
            for k, ids in zip(owner[i:j], self._group(parts[i:j]), strict=True):
                out[k].append(ids)
        return [x[0] if len(x) == 1 else b"".join(x) for x in out]

    def _group(self, parts: list[bytes]) -> Iterator[bytes]:
        split = pc.ascii_split_whitespace(pa.array(parts, pa.binary()).cast(pa.string()))
        coded = split.values.dictionary_encode()
        taken = self._words(coded.dictionary).take(coded.indices)
        at, ids = taken.offsets.to_numpy()[split.offsets.to_numpy()].tolist(), taken.values.to_numpy()
        for a, b in zip(at, at[1:], strict=False):
            yield ids[a:b].tobytes()

    def _words(self, words: pa.StringArray) -> pa.LargeListArray:
        """Ids of distinct words: letters and the marks at their end apart, other words whole."""
        bases = pc.ascii_rtrim(words, characters=_SUFFIX.decode())
        plain = pc.and_(pc.utf8_is_alpha(bases), pc.match_substring_regex(bases, _NEAR))
        letters = bases.filter(plain).dictionary_encode()
        plain, size = plain.to_numpy(zero_copy_only=False), pc.binary_length(bases).to_numpy()
        tailed = np.flatnonzero(plain & (size < pc.binary_length(words).to_numpy()))
        others = np.flatnonzero(~plain)
        rest: dict[bytes, int] = {}
        place = lambda found: [rest.setdefault(x, len(rest)) for x in found]
        raw = words.cast(pa.binary())
        tails = place([w[n:] for w, n in zip(raw.take(pa.array(tailed)).to_pylist(), size[tailed].tolist(), strict=True)])
        wholes = place(raw.take(pa.array(others)).to_pylist())
        pool = [self._letters(letters.dictionary), self._each([w.decode() for w in rest])]
        sizes = np.concatenate([*(n for _, n in pool), [0]])
        first = len(letters.dictionary)
        # each word is two of the pool: its letters, and its marks or itself; the last one is empty
        pairs = np.full((len(words), 2), len(sizes) - 1, np.int64)
        pairs[plain, 0] = letters.indices.to_numpy()
        pairs[tailed, 1] = np.array(tails, np.int64) + first
        pairs[others, 1] = np.array(wholes, np.int64) + first
        both = _lists(np.concatenate([x for x, _ in pool]), sizes).take(pa.array(pairs.ravel()))
        return pa.LargeListArray.from_arrays(pa.array(both.offsets.to_numpy()[::2]), both.values)

    def _each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after another, and how many each has."""
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]
        return np.array(list(chain.from_iterable(ids)), np.uint32), np.array(list(map(len, ids)), np.int64)

    def _letters(self, words: pa.StringArray) -> tuple[np.ndarray, np.ndarray]:
        """As ``_each``; words of letters alone are one pre-token each, so a run of them splits where tokens end a word."""
        starts = np.r_[np.arange(0, len(words), _WORDS_AT_ONCE), len(words)]
        runs = pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), words), " ").to_pylist()
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for run, e in zip(runs, self.tokenizer.encode_batch_fast(runs, add_special_tokens=False), strict=True):
            x = np.array(e.ids, np.uint32)
            ends = np.flatnonzero(self.ends[x]) + 1
            n = np.diff(ends, prepend=0)
            if len(ends) != run.count(" ") + 1 or ends[-1] != len(x):  # a letter that lower-cases to more than letters
                x, n = self._each(run.split(" "))
            ids.append(x)
            sizes.append(n)
        return np.concatenate(ids), np.concatenate(sizes)


def _lists(ids: np.ndarray, sizes: np.ndarray) -> pa.LargeListArray:
    return pa.LargeListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int64)), pa.array(ids))


def gathered(batches: Iterable[pa.RecordBatch], text: int, most: int = GROUP_BYTES) -> Iterator[tuple[list[pa.Array], list[bytes]]]:
    """Batches put together to about ``most`` bytes of text: all columns but the text's, and the texts."""
    held: list[pa.RecordBatch] = []
    texts: list[bytes] = []
    size = 0

    def columns() -> list[pa.Array]:
        return [pa.concat_arrays([b.column(i) for b in held]) for i in range(held[0].num_columns) if i != text]

    for b in batches:
        if not b.num_rows:
            continue
        got = text_bytes(b.column(text))
        held.append(b)
        texts += got
        size += sum(map(len, got))
        if size >= most:
            yield columns(), texts
            held, texts, size = [], [], 0
    if held:
        yield columns(), texts
