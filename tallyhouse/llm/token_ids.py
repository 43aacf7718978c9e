"""Token ids of whole texts by the ``tokenizers`` library, each distinct word run once per batch.

A byte-level tokenizer splits a text before it merges bytes, and always between
a character that is no white space and the white space behind it, and between
a letter and a mark. The runs between such places are encoded apart, so their ids can be reused: distinct
runs of a batch are found by hash, new ones are encoded, and the batch's ids are
put together from them. A worker remembers runs in flat arrays, some 30 bytes for
each. Other tokenizers encode whole texts.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa

from tallyhouse.llm.text_bytes import prefix_sums, slices, stretch_hash, utf8

#: Runs remembered per worker.
REMEMBERED = 3_000_000

#: Runs encoded in one call.
TOGETHER = 2000

_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_MARK = np.zeros(256, bool)
_MARK[list(b'.,;:!?()"-/')] = True  # not the apostrophe, which may begin a run with letters
_OPEN: dict[str, TokenIds] = {}


def _wide_space_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the character that ends before ``at`` is white space of more than one byte."""
    one, two, three = (data[np.maximum(at - k, 0)] for k in (1, 2, 3))
    return (
        (two == 0xC2) & ((one == 0x85) | (one == 0xA0))
        | (three == 0xE2) & (two == 0x80) & ((one <= 0x8A) | (one == 0xA8) | (one == 0xA9) | (one == 0xAF))
        | (three == 0xE2) & (two == 0x81) & (one == 0x9F)
        | (three == 0xE3) & (two == 0x80) & (one == 0x80)
        | (three == 0xE1) & (two == 0x9A) & (one == 0x80)
    )


def _letter_before(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether an ASCII or Latin-1 letter ends before ``at``; other letters may be missed."""
    one, two = data[at - 1], data[np.maximum(at - 2, 0)]
    return _LETTER[one] | (two == 0xC3) & (one >= 0x80) & (one != 0x97) & (one != 0xB7)


class Known:
    """Runs by their hash, in order, and where the ids of each lie among those of all."""

    def __init__(self, kind: np.dtype):
        self.keys, self.first, self.size = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.ids = np.zeros(0, kind)

    def __len__(self) -> int:
        return len(self.keys)

    def missing(self, keys: np.ndarray) -> np.ndarray:
        """Which of ``keys``, in order, are not known."""
        at = np.searchsorted(self.keys, keys)
        known = at < len(self.keys)
        known[known] = self.keys[at[known]] == keys[known]
        return np.flatnonzero(~known)

    def add(self, keys: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Adds ``keys``, which are in order and not known; ``ids`` are theirs behind each other."""
        at = np.searchsorted(self.keys, keys)
        first = len(self.ids) + np.cumsum(sizes) - sizes
        self.keys, self.first, self.size = (np.insert(old, at, new) for old, new in ((self.keys, keys), (self.first, first), (self.size, sizes)))
        self.ids = np.concatenate([self.ids, ids])

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of known ``keys``, where their ids begin and how many they are."""
        at = np.searchsorted(self.keys, keys)
        return self.first[at], self.size[at].astype(np.int64)


def _stretches(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places of all stretches, one behind the other."""
    upto = np.cumsum(size)
    return np.repeat(first - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)


class TokenIds:
    """A tokenizer file, opened once per worker."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks use the cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            made = json.load(file)
        before = made.get("pre_tokenizer") or {}
        self.in_runs = made.get("normalizer") is None and before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
        self.kind = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known = Known(self.kind)
        self.token_bytes: np.ndarray | None = None

    @staticmethod
    def of(path: str) -> TokenIds:
        if path not in _OPEN:
            _OPEN[path] = TokenIds(path)
        return _OPEN[path]

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.kind) for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _token_bytes(self) -> np.ndarray:
        """The bytes of each token: a byte-level token has a letter for each, an added one is written as it is."""
        if self.token_bytes is None:
            added = self.tokenizer.get_added_tokens_decoder()
            self.token_bytes = np.zeros(self.tokenizer.get_vocab_size(), np.int64)
            for token, i in self.tokenizer.get_vocab().items():
                if i < len(self.token_bytes):
                    self.token_bytes[i] = len(token.encode()) if i in added else len(token)
        return self.token_bytes

    def _cuts(self, encoded, ids: np.ndarray, raw: bytes, run_at: np.ndarray) -> np.ndarray:
        """Where the ids of each run begin in those of all, and where the last end."""
        token_at = np.concatenate([[0], np.cumsum(self._token_bytes()[ids])])
        cuts = np.searchsorted(token_at, run_at)
        if token_at[-1] == run_at[-1] and (token_at[cuts] == run_at).all():
            return cuts
        # tokens that are not all of the text's bytes: a token begins in its run, also where its white space is not counted
        token_at = np.fromiter((o[0] for o in encoded.offsets), np.int64, len(ids))
        at = run_at.tolist()
        run_at = np.cumsum([0, *(len(raw[a:b].decode()) for a, b in zip(at[:-2], at[1:-1], strict=True))])
        return np.append(np.searchsorted(token_at, run_at), len(ids))

    def _encoded_runs(self, data: np.ndarray, first: np.ndarray, size: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each run of ``data`` has, and the ids. Plain runs, from white space to a letter or mark, are written behind each other and encoded together."""
        sizes, found = np.zeros(len(first), np.int64), [np.zeros(0, self.kind)]
        joined, alone = np.flatnonzero(plain), np.flatnonzero(~plain)
        for lo in range(0, len(joined), TOGETHER):
            some = joined[lo : lo + TOGETHER]
            raw = data[_stretches(first[some], size[some])].tobytes()
            encoded = self.tokenizer.encode(raw.decode(), add_special_tokens=False)
            found.append(np.array(encoded.ids, self.kind))
            sizes[some] = np.diff(self._cuts(encoded, found[-1], raw, np.concatenate([[0], np.cumsum(size[some])])))
        for lo in range(0, len(alone), TOGETHER):
            some = alone[lo : lo + TOGETHER]
            each = self._encoded([data[a:b].tobytes().decode() for a, b in zip(first[some].tolist(), (first[some] + size[some]).tolist(), strict=True)])
            sizes[some] = [len(ids) for ids in each]
            found += each
        order = np.concatenate([joined, alone])
        begin = np.empty(len(first), np.int64)
        begin[order] = np.cumsum(sizes[order]) - sizes[order]
        return sizes, np.concatenate(found)[_stretches(begin, sizes)]

    def slice_ids(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of consecutive texts, and where each text's begin and end."""
        data, at = data[at[0] : at[-1]], at - at[0]
        if not self.in_runs:
            raw = data.tobytes()
            each = self._encoded([raw[a:b].decode() for a, b in zip(at.tolist(), at[1:].tolist(), strict=False)])
            return np.concatenate([np.zeros(0, self.kind), *each]), np.cumsum([0, *map(len, each)])
        space = _SPACE[data]
        cut = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        cut = cut[~_wide_space_before(data, cut)] if len(cut) else cut
        mark = np.flatnonzero(_MARK[data[1:]]) + 1
        begins = np.zeros(len(data) + 1, bool)
        begins[cut] = begins[at[:-1]] = begins[mark[_letter_before(data, mark)]] = True
        starts = np.flatnonzero(begins[:-1])
        ends = np.append(starts[1:], len(data)) if len(starts) else starts
        of, runs = pd.factorize(stretch_hash(prefix_sums(data), starts, ends))
        place = np.empty(len(runs), np.int64)
        place[of[::-1]] = np.arange(len(of))[::-1]
        if len(self.known) > REMEMBERED:
            self.known = Known(self.kind)
        order = np.argsort(runs)
        ordered = runs[order]
        new = self.known.missing(ordered)
        place = place[order[new]]
        first, last = starts[place], ends[place]
        closed = (data[last - 1] > 32) & (data[last - 1] < 127) | _letter_before(data, last)
        self.known.add(ordered[new], *self._encoded_runs(data, first, last - first, space[first] & closed))
        begin, size = np.empty(len(runs), np.int64), np.empty(len(runs), np.int64)
        begin[order], size[order] = self.known.places(ordered)
        each = size[of]
        upto = np.concatenate([[0], np.cumsum(each)])
        return self.known.ids[_stretches(begin[of], each)], upto[np.searchsorted(starts, at)]

    def texts_ids(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; null is empty."""
        for lo, hi in slices(column):
            ids, at = self.slice_ids(*utf8(column.slice(lo, hi - lo)))
            for a, b in zip(at.tolist(), at[1:].tolist(), strict=False):
                yield ids[a:b]


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")
