"""Byte-pair encoding and decoding with segment trees over adjacent pair ranks."""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubweave.llm.common import runs, slices, turn

#: Unicode white space, as the tokenizer file's pre-tokenizer has it.
SPACE = r"\t-\r \x85\xa0  -     　"
#: The pre-tokenizer's pattern.
PIECES = regex.compile(rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: No piece crosses from other characters to white space, so these are encoded on their own.
CHUNKS = re.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
NONE = np.int64(1) << 62


def byte_letters() -> dict[str, int]:
    """The letter by which the vocabulary writes each byte: printable Latin-1 characters
    stand for themselves, the other bytes follow from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Tokenizer:
    """A byte-level BPE vocabulary, and the chunks encoded so far, up to about ``remember`` bytes;
    beyond that all are forgotten, which costs time and changes nothing."""

    def __init__(self, path: str, remember: int = 96 << 20):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab, letters = spec["model"]["vocab"], byte_letters()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*vocab.values(), *added.values()]) + 1
        self.token_bytes = [b""] * size
        for token, i in {**vocab, **added}.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        self.byte_id = np.zeros(256, np.int64)
        for letter, b in letters.items():
            self.byte_id[b] = vocab[letter]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        pairs = np.array([vocab[a] << 20 | vocab[b] for a, b in merges], np.int64)
        order = np.argsort(pairs)
        self.pairs, self.ranks = pairs[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in merges], np.int64)  # by rank
        self.added = added
        self.split_added = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.decimals = _Ragged([b"%d," % i for i in range(size)])
        self.spelled = _Ragged(self.token_bytes)
        self.remember = remember
        self._forget()

    def _forget(self) -> None:
        self.known = {text: k for k, text in enumerate(self.added)}
        self.store = np.array(list(self.added.values()), np.int32)
        self.sizes = np.ones(len(self.added), np.int64)
        self.starts = np.arange(len(self.added))
        self.held = 0

    def _keep(self, chunks: list[str], ids: np.ndarray, sizes: np.ndarray) -> None:
        self.known.update(zip(chunks, range(len(self.starts), len(self.starts) + len(chunks)), strict=True))
        self.starts = np.concatenate([self.starts, len(self.store) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.store = np.concatenate([self.store, ids])
        self.held += sum(map(len, chunks)) + 150 * len(chunks) + 4 * len(ids)  # text, object and table entry, ids

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where it doesn't merge."""
        pair = left << 20 | right
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where((self.pairs[at] == pair) & (left >= 0) & (right >= 0), self.ranks[at], NONE)

    def merge_pieces(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and where those of each piece start and how many they are. Pieces of like
        length are merged side by side, each in a segment tree of its own, a row of a matrix."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        width = np.maximum(2, 1 << np.ceil(np.log2(np.maximum(lengths, 1))).astype(np.int64))
        starts, sizes, parts, used = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64), [np.empty(0, np.int32)], 0
        for w in np.unique(width).tolist():
            own = np.flatnonzero(width == w)
            step = max(1, (1 << 16) // w)
            for k in range(0, len(own), step):
                some = own[k : k + step]
                ids, n = self._forest([pieces[i] for i in some.tolist()], w)
                starts[some], sizes[some] = used + np.cumsum(n) - n, n
                parts.append(ids)
                used += len(ids)
        return np.concatenate(parts), starts, sizes

    def _forest(self, pieces: list[bytes], w: int) -> tuple[np.ndarray, np.ndarray]:
        """Leaf i of a tree is the pair that starts at symbol i, keyed by rank and then by
        position; a node is the least of its two. The root names the next merge, which
        changes three leaves and the nodes above them. Returns all ids and each piece's number."""
        n, bits = len(pieces), w.bit_length()
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        flat = self.byte_id[np.frombuffer(b"".join(pieces), np.uint8)]
        row = np.repeat(np.arange(n), lengths)
        col = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        sym = np.full((n, w), -1, np.int64)
        sym[row, col] = flat
        after = np.tile(np.arange(1, w + 1), (n, 1))
        after[after >= lengths[:, None]] = w
        prior = np.tile(np.arange(-1, w - 1), (n, 1))
        tree = np.full((n, 2 * w), NONE, np.int64)
        tree[:, w : 2 * w - 1] = self._keyed(sym[:, :-1], sym[:, 1:], np.arange(w - 1), bits)
        level = w
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        sym1, after1, prior1, tree1 = sym.reshape(-1), after.reshape(-1), prior.reshape(-1), tree.reshape(-1)
        live = np.flatnonzero(tree[:, 1] < NONE)
        while len(live):
            root, base = tree1[live * (2 * w) + 1], live * w
            at, rank = root & ((1 << bits) - 1), root >> bits
            gone = after1[base + at]
            behind = after1[base + gone]
            new = self.merged[rank]
            sym1[base + at] = new
            sym1[base + gone] = -1
            after1[base + at] = behind
            has = behind < w
            prior1[(base + behind)[has]] = at[has]
            before = prior1[base + at]
            led = before >= 0
            right = np.where(has, sym1[base + np.minimum(behind, w - 1)], -1)
            left = np.where(led, sym1[base + np.maximum(before, 0)], -1)
            keys = self._keyed(np.concatenate([new, left]), np.concatenate([right, new]), np.concatenate([at, before]), bits)
            m = len(live)
            leaf = np.concatenate([base + base + w + gone, base + base + w + at, (base + base + w + before)[led]])
            tree1[leaf] = np.concatenate([np.full(m, NONE), keys[:m], keys[m:][led]])
            node, above, level = np.concatenate([gone, at, before[led]]) + w, np.concatenate([2 * base, 2 * base, 2 * base[led]]), w
            while level > 1:
                node >>= 1
                here = above + node
                tree1[here] = np.minimum(tree1[here + node], tree1[here + node + 1])
                level >>= 1
            live = live[tree1[live * (2 * w) + 1] < NONE]
        there = sym >= 0
        return sym[there].astype(np.int32), there.sum(1)

    def _keyed(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, bits: int) -> np.ndarray:
        rank = self._rank(left, right)
        return np.where(rank < NONE, rank << bits | at, NONE)

    def _chunks(self, text: str) -> list[str]:
        if self.split_added is None or not any(a in text for a in self.added):
            return CHUNKS.findall(text)
        parts = self.split_added.split(text)
        return [c for i, p in enumerate(parts) for c in ([p] if i % 2 else CHUNKS.findall(p))]

    def _learn(self, new: list[str]) -> None:
        pieces = [PIECES.findall(c) for c in new]
        index: dict[str, int] = {}
        at = np.array([index.setdefault(p, len(index)) for ps in pieces for p in ps], np.int64)
        ids, starts, sizes = self.merge_pieces([p.encode("utf-8", "replace") for p in index])
        ends = np.cumsum(np.r_[0, sizes[at]])[np.cumsum([0, *map(len, pieces)])]
        self._keep(new, _gather(ids, starts[at], sizes[at]), np.diff(ends))

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """All ids in a row, and the number of ids of each text; null counts as empty."""
        if self.held > self.remember:
            self._forget()
        lists = [self._chunks(t or "") for t in texts]
        chunks = list(chain.from_iterable(lists))
        at = np.array(list(map(self.known.get, chunks, repeat(-1))), np.int64)
        unknown = np.flatnonzero(at < 0).tolist()
        if unknown:
            self._learn(list(dict.fromkeys(chunks[i] for i in unknown)))
            at[unknown] = [self.known[chunks[i]] for i in unknown]
        sizes = self.sizes[at]
        ids = _gather(self.store, self.starts[at], sizes)
        ends = np.cumsum(np.r_[0, sizes])[np.cumsum([0, *map(len, lists)])]
        return ids, np.diff(ends)

    def decode(self, ids: np.ndarray) -> str:
        return self.spelled.join(ids).decode("utf-8", "replace")


class _Ragged:
    """Byte strings in one buffer."""

    def __init__(self, items: list[bytes]):
        self.data = np.frombuffer(b"".join(items), np.uint8)
        self.sizes = np.fromiter(map(len, items), np.int64, len(items))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def join(self, which: np.ndarray) -> bytes:
        return _gather(self.data, self.starts[which], self.sizes[which]).tobytes()


def _gather(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ranges of ``data``, one after the other."""
    ends = np.cumsum(sizes)
    if not len(ends) or not ends[-1]:
        return data[:0]
    return data[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1])]


@lru_cache(maxsize=2)
def tokenizer(path: str | Callable[[], str]) -> Tokenizer:
    """One per Python worker and file. A function gives the path where the worker runs."""
    return Tokenizer(path() if callable(path) else path)


def encode(text: Column, path: str | Callable[[], str]) -> Column:
    """array<int>: the ids of a whole text; null counts as empty, and gives no ids."""

    @F.pandas_udf("array<int>")
    def ids(texts: pd.Series) -> pd.Series:
        with turn("bpe", tokenizer.cache_clear):
            own, out = tokenizer(path), []
            for run in runs(texts.tolist()):
                found, sizes = own.encode_batch(run)
                out += np.split(found, np.cumsum(sizes)[:-1])
            return pd.Series(out, dtype=object)

    return ids(text)


def decode(ids: Column, path: str | Callable[[], str]) -> Column:
    """The text of ids, special tokens included; broken UTF-8 becomes U+FFFD. Null: null."""

    @F.pandas_udf("string")
    def text(lists: pd.Series) -> pd.Series:
        with turn("bpe", tokenizer.cache_clear):
            own = tokenizer(path)
            return pd.Series([None if x is None else own.decode(np.asarray(x, np.int64)) for x in lists], dtype=object)

    return text(ids)


def token_digests(df: DataFrame, path: str | Callable[[], str], id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256 (of the decimal ids joined by commas),
    decoded_sha256 (of the text that the ids decode to) and, if asked for, the ids
    themselves. Null text counts as empty. Ids may repeat or be null; an empty table gives
    no rows; other columns are ignored. A text is encoded whole, however long.
    """

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with turn("bpe", tokenizer.cache_clear):
            yield from digested(batches)

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = tokenizer(path)
        for batch in slices(batches):
            counts, ids_sha, text_sha, all_ids = [], [], [], []
            for run in runs(batch.column(1).to_pylist()):
                ids, sizes = own.encode_batch(run)
                all_ids.append(ids)
                for part in np.split(ids, np.cumsum(sizes)[:-1]):
                    counts.append(len(part))
                    ids_sha.append(hashlib.sha256(own.decimals.join(part)[:-1]).hexdigest())
                    text_sha.append(hashlib.sha256(own.decode(part).encode()).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            if with_ids:
                offsets = np.cumsum([0, *counts]).astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([np.empty(0, np.int32), *all_ids]).astype(np.int32))))
            yield pa.record_batch(columns, names)

    names = [id_col, "n_tokens", "ids_sha256", "decoded_sha256", *(["ids"] if with_ids else [])]

    kind = f"`{id_col}` {df.schema[id_col].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string{", ids array<int>" if with_ids else ""}"
    return df.select(id_col, text_col).mapInArrow(digests, kind)
