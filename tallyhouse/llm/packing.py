"""Packing documents into sequences by lexical retrieval.

A document's ids, closed by an end id, give whole sequences as long as they
last; the rest, shorter than a sequence, is packed with others. The rests are
dealt into shards of about ``SHARD`` documents by lexical likeness: their terms,
weighted by BM25 over all rests, are drawn down to ``DIMENSIONS`` numbers, and a
tree that splits a sample of them along the widest direction, at the middle,
gives the shards. Each shard has an inverted index with BM25 weights; document
frequencies and the mean length are those of all rests. A seed document opens a
window, the index returns its unused neighbours in order of their score, and
those that still fit are taken. When none fits, the best neighbour is cut: its
beginning fills the window and its end remains to be packed. So only a shard's
last window has padding. A neighbour in another shard is not found; the README
says how many are.

Ids are made once and staged, and only the rests are shuffled; of whole sequences
only the checksums travel. A shard is one task of bounded memory: a leaf of the
tree that holds many copies is cut into several by row, so they spread. The
sample has ``PER_SHARD`` documents for each shard, so the tree grows with the
rows (4 KB a shard on the driver).

Cases: a null or empty text is the end id alone; a document without an id keeps
null; repeated rows are packed each; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyhouse.llm.token_ids import TokenIds, default_path
from tallyhouse.staging import stage

WINDOW = 1024
END_ID = 0
SHARD = 512
K1, B = 1.2, 0.75
DIMENSIONS = 64
#: Sampled documents per shard, and the least sample.
PER_SHARD, LEAST_SAMPLE = 16, 8192


def checksum(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _encoded(path: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = TokenIds.of(path)
        for batch in batches:
            rows = []
            for ids in tokens.texts_ids(batch.column(1)):
                ids = np.append(ids, tokens.kind.type(END_ID))
                whole = len(ids) // window
                rows.append((len(ids), [checksum(ids[i * window : (i + 1) * window]) for i in range(whole)], ids[whole * window :].astype("<u4").tobytes() if tokens.kind.itemsize == 4 else ids[whole * window :].tobytes()))
            columns = list(zip(*rows, strict=True)) or [()] * 3
            arrays = [pa.array(c, k) for c, k in zip(columns, [pa.int64(), pa.list_(pa.int64()), pa.binary()], strict=True)]
            width = pa.array([tokens.kind.itemsize] * len(rows), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), *arrays, width], ["doc_id", "doc_tokens", "whole", "rest", "id_bytes"])

    return run


class Corpus(NamedTuple):
    """Of all rests: their number, their mean length, and in how many of them each term is."""

    n: int
    mean: float
    found: np.ndarray

    @property
    def rarity(self) -> np.ndarray:
        return np.log1p((self.n - self.found + 0.5) / (self.found + 0.5))


def _rests(batch: pa.RecordBatch) -> list[np.ndarray]:
    names = batch.schema.names
    return [np.frombuffer(r, f"<u{w}") for r, w in zip(batch.column(names.index("rest")).to_pylist(), batch.column(names.index("id_bytes")).to_pylist(), strict=True)]


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per term the documents of a task; the rests and their ids in all are the rows of terms -1 and -2."""
    found, n, total = np.zeros(1, np.int64), 0, 0
    for batch in batches:
        documents = _rests(batch)
        terms = np.concatenate([np.unique(ids) for ids in documents]) if documents else np.zeros(0, np.int64)
        more = np.bincount(terms, minlength=len(found))
        more[: len(found)] += found
        found, n, total = more, n + len(documents), total + sum(len(ids) for ids in documents)
    term = np.flatnonzero(found)
    columns = [np.append(term, [-1, -2]), np.append(found[term], [n, total])]
    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["term", "n"])


def corpus(encoded: DataFrame) -> Corpus:
    """One row per term of the tokenizer comes to the driver, whatever the number of documents."""
    rows = encoded.select("rest", "id_bytes").mapInArrow(_found, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toPandas()
    by = dict(zip(rows["term"].tolist(), rows["n"].tolist(), strict=True))
    n, total = by.pop(-1, 0), by.pop(-2, 0)
    found = np.zeros(max(by, default=0) + 1, np.int64)
    found[list(by)] = list(by.values())
    return Corpus(n, total / max(n, 1), found)


_DRAWN: dict[int, np.ndarray] = {}


def likeness(documents: list[np.ndarray], of: Corpus) -> np.ndarray:
    """Per document its BM25 weights, drawn down to ``DIMENSIONS`` numbers, of length 1."""
    if len(of.found) not in _DRAWN:
        _DRAWN.clear()
        _DRAWN[len(of.found)] = np.random.default_rng(8).standard_normal((len(of.found), DIMENSIONS), np.float32)
    drawn, rarity = _DRAWN[len(of.found)], of.rarity
    out = np.zeros((len(documents), DIMENSIONS), np.float32)
    for i, ids in enumerate(documents):
        terms, counts = np.unique(ids, return_counts=True)
        norm = K1 * (1 - B + B * len(ids) / max(of.mean, 1))
        out[i] = (rarity[terms] * counts / (counts + norm)).astype(np.float32) @ drawn[terms]
    return out / np.maximum(np.sqrt((out * out).sum(1, keepdims=True)), 1e-12)


class Tree(NamedTuple):
    """Per node the direction and the place of its cut, and its two children; a leaf is -1 - its number."""

    direction: np.ndarray
    cut: np.ndarray
    child: np.ndarray

    @staticmethod
    def of(sample: np.ndarray, leaves: int) -> Tree:
        """``leaves`` leaves that share the sample evenly."""
        direction, cut, child, numbered = [], [], [], 0
        todo = [(np.arange(len(sample)), leaves, -1, 0)]
        while todo:
            rows, share, parent, side = todo.pop()
            if share > 1:
                here = len(cut)
                x = sample[rows] - sample[rows].mean(0) if len(rows) else np.zeros((1, DIMENSIONS), np.float32)
                axis = np.linalg.eigh((x.T @ x).astype(float))[1][:, -1].astype(np.float32)
                at = (sample[rows] * axis).sum(1)
                place = float(np.quantile(at, share // 2 / share)) if len(rows) else 0.0
                direction.append(axis)
                cut.append(place)
                child.append([0, 0])
                todo += [(rows[at <= place], share // 2, here, 0), (rows[at > place], share - share // 2, here, 1)]
            else:
                here, numbered = -1 - numbered, numbered + 1
            if parent >= 0:
                child[parent][side] = here
        return Tree(np.array(direction, np.float32).reshape(-1, DIMENSIONS), np.array(cut), np.array(child, np.int64).reshape(-1, 2))

    def leaf(self, vectors: np.ndarray) -> np.ndarray:
        node = np.zeros(len(vectors), np.int64)
        inner = np.arange(len(vectors) if len(self.cut) else 0)
        while len(inner):
            at = node[inner]
            high = (vectors[inner] * self.direction[at]).sum(1) > self.cut[at]
            node[inner] = self.child[at, high.astype(np.int64)]
            inner = inner[node[inner] >= 0]
        return -1 - node if len(self.cut) else node


def _sampled(of: Corpus):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([v.tobytes() for v in likeness(_rests(batch), of)], pa.binary())], ["vector"])

    return run


def _dealt(of: Corpus, tree: Tree):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            leaf = tree.leaf(likeness(_rests(batch), of))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(leaf)], [*batch.schema.names, "leaf"])

    return run


def dealt(encoded: DataFrame, of: Corpus, shard: int) -> DataFrame:
    """``encoded`` with the number of its shard, like documents in one; a leaf of far too many is cut by row."""
    leaves = max(1, -(-of.n // shard))
    every = max(1, of.n // max(LEAST_SAMPLE, PER_SHARD * leaves))
    some = encoded.filter(F.pmod(F.xxhash64("number"), F.lit(every)) == 0).select("rest", "id_bytes")
    drawn = some.mapInArrow(_sampled(of), "vector binary").collect() if leaves > 1 else []
    sample = np.frombuffer(b"".join(sorted(bytes(r.vector) for r in drawn)), np.float32).reshape(-1, DIMENSIONS)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema)
    rows = stage(encoded.mapInArrow(_dealt(of, Tree.of(sample, leaves)), f"{schema}, leaf long"), "packing-dealt")
    sizes = rows.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / (1.5 * shard)).cast("int").alias("pieces")).filter("pieces > 1")
    piece = F.pmod(F.xxhash64("number"), F.coalesce("pieces", F.lit(1)))
    return rows.join(sizes, "leaf", "left").withColumn("shard", F.col("leaf") + leaves * piece)


class Index:
    """An inverted index of one shard: per term its documents and their BM25 weights, by the frequencies of ``of`` or else of the shard."""

    def __init__(self, documents: list[np.ndarray], of: Corpus | None = None):
        per = [np.unique(ids, return_counts=True) for ids in documents]
        sizes = np.array([len(t) for t, _ in per])
        terms = np.concatenate([t for t, _ in per])
        counts = np.concatenate([c for _, c in per]).astype(float)
        owner = np.repeat(np.arange(len(documents)), sizes)
        known, term = np.unique(terms, return_inverse=True)
        found = np.bincount(term, minlength=len(known))
        length = np.array([len(ids) for ids in documents], float)
        own = of or Corpus(len(documents), length.mean(), found)
        rarity = own.rarity[known] if of else own.rarity
        norm = K1 * (1 - B + B * length / max(own.mean, 1))
        weight = rarity[term] * counts * (K1 + 1) / (counts + norm[owner])
        order = np.argsort(term, kind="stable")
        self.owner, self.weight = owner[order], weight[order]
        self.start = np.concatenate([[0], np.cumsum(found)])
        self.terms = np.split(term, np.cumsum(sizes)[:-1])
        self.n = len(documents)

    def scores(self, document: int) -> np.ndarray:
        """The BM25 score of every document for the terms of one."""
        terms = self.terms[document]
        first, size = self.start[terms], self.start[terms + 1] - self.start[terms]
        upto = np.cumsum(size)
        places = np.repeat(first - (upto - size), size) + np.arange(upto[-1] if len(upto) else 0)
        return np.bincount(self.owner[places], self.weight[places], minlength=self.n)


def windows(documents: list[np.ndarray], window: int, of: Corpus | None = None) -> Iterator[list[tuple[int, int, int]]]:
    """Fills windows with pieces: document, start in it, length. Every id is in one piece."""
    length = np.array([len(ids) for ids in documents])
    taken = np.zeros(len(documents), np.int64)  # ids of the document that are packed already
    left = length.copy()
    index = Index(documents, of) if len(documents) else None
    for seed in np.argsort(-length, kind="stable").tolist():
        while left[seed]:
            pieces, free = [], window

            def put(document: int, size: int, pieces: list = pieces) -> None:
                pieces.append((document, int(taken[document]), size))
                taken[document] += size
                left[document] -= size

            size = int(min(left[seed], free))
            put(seed, size)
            free -= size
            if free:
                near = np.argsort(-index.scores(seed), kind="stable")
                near = near[left[near] > 0]
                while free and len(near):
                    fits = np.flatnonzero(left[near] <= free)
                    at = int(fits[0]) if len(fits) else 0
                    size = int(min(left[near[at]], free))
                    put(int(near[at]), size)
                    free -= size
                    near = near[left[near] > 0]
            yield pieces


def _packed(window: int, of: Corpus):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["doc_tokens", "rest"], ignore_index=True)
        documents = [np.frombuffer(r, f"<u{w}") for r, w in zip(rows["rest"], rows["id_bytes"], strict=True)]
        base, ids = int(rows["shard"].iloc[0]) << 28, rows["doc_id"].tolist()
        totals, out = rows["doc_tokens"].tolist(), []
        sequence = 0
        for i, sums in enumerate(rows["whole"]):
            for k, total in enumerate(sums):
                out.append((ids[i], k * window, window, int(total), totals[i], base + sequence, 0))
                sequence += 1
        for pieces in windows(documents, window, of):
            offset = 0
            for i, start, size in pieces:
                before = totals[i] - len(documents[i])
                out.append((ids[i], before + start, size, checksum(documents[i][start : start + size]), totals[i], base + sequence, offset))
                offset += size
            sequence += 1
        made = pd.DataFrame(out, columns=[c.split()[0] for c in PIECE.split(", ")])
        made["doc_id"] = pd.array([None if pd.isna(x) else int(x) for x in made["doc_id"]], "Int64")
        return made

    return run


PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, path: str | None = None, window: int = WINDOW, shard: int = SHARD) -> DataFrame:
    """One row per piece: document, place in it, length, checksum, and place in its sequence."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    made = rows.mapInArrow(_encoded(path or default_path(), window), "doc_id long, doc_tokens long, whole array<long>, rest binary, id_bytes int")
    encoded = stage(made.withColumn("number", F.monotonically_increasing_id()), "packing-rests")
    of = corpus(encoded)
    return dealt(encoded, of, shard).groupBy("shard").applyInPandas(_packed(window, of), PIECE)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
