"""Counts over lists of words by numbers instead of strings: runs in the Python workers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_ROWS = 1024
#: Pairs a task holds before it counts them and passes them on.
HELD_PAIRS = 4_000_000


def _numbered(batches: Iterable[pa.RecordBatch], words: pa.Array) -> Iterator[tuple]:
    """Per slice of rows: each word's place in ``words`` (-1: none), its row, where a pair is in one row, the slice."""
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            part = batch.slice(at, SLICE_ROWS)
            lists = part.column(0)
            sizes = pc.fill_null(lists.value_lengths(), 0).to_numpy(zero_copy_only=False)
            ids = pc.fill_null(pc.index_in(lists.flatten(), value_set=words), -1)
            ids = ids.to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(sizes.size), sizes)
            yield ids, row, (row[:-1] == row[1:]) & (ids[:-1] >= 0) & (ids[1:] >= 0), part


def pair_counts(batches: Iterable[pa.RecordBatch], words: pa.Array) -> Iterator[pa.RecordBatch]:
    """(key, n): how often two of ``words`` stand side by side, in parts of ``HELD_PAIRS`` pairs."""
    held, size = [], 0

    def out():
        keys, counts = np.unique(np.concatenate(held or [np.empty(0, np.int64)]), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(counts)], ["key", "n"])

    for ids, _, pair, _ in _numbered(batches, words):
        held.append(ids[:-1][pair] * len(words) + ids[1:][pair])
        size += held[-1].size
        if size > HELD_PAIRS:
            yield out()
            held, size = [], 0
    yield out()


def named_pairs(batches: Iterable[pa.RecordBatch], words: pa.Array) -> Iterator[pa.RecordBatch]:
    """(a, b, total) of (key, total), the keys as ``pair_counts`` makes them."""
    for batch in batches:
        a, b = np.divmod(batch.column(0).to_numpy(zero_copy_only=False), max(len(words), 1))
        yield pa.RecordBatch.from_arrays(
            [words.take(pa.array(a)), words.take(pa.array(b)), batch.column(1)], ["a", "b", "total"])


def _term_cells(batches: Iterable[pa.RecordBatch], terms: list[str]) -> Iterator[tuple]:
    """Per slice of rows: (row, place in ``terms``) as one number, sorted, its count, and the slice.

    A term is a word or a pair with a space between.
    """
    parts = [t.split(" ") for t in terms]
    words = sorted({w for p in parts for w in p})
    at = {w: i for i, w in enumerate(words)}
    single, pairs = np.full(len(words), -1), {}
    for i, p in enumerate(parts):
        if len(p) == 1:
            single[at[p[0]]] = i
        elif len(p) == 2:
            pairs[at[p[0]] * len(words) + at[p[1]]] = i
    pair_keys = np.array([*sorted(pairs), np.iinfo(np.int64).max])
    pair_place = np.array([*(pairs[k] for k in pair_keys[:-1].tolist()), -1])
    for ids, row, pair, part in _numbered(batches, pa.array(words, pa.string())):
        known = ids >= 0
        place, of = single[ids[known]], row[known]
        keys, of_pair = ids[:-1][pair] * len(words) + ids[1:][pair], row[:-1][pair]
        slot = np.searchsorted(pair_keys, keys)
        hit = pair_keys[slot] == keys
        place, of = np.concatenate([place, pair_place[slot[hit]]]), np.concatenate([of, of_pair[hit]])
        yield *np.unique((of * len(terms) + place)[place >= 0], return_counts=True), part


def document_counts(batches: Iterable[pa.RecordBatch], terms: list[str]) -> Iterator[pa.RecordBatch]:
    """(i, n): in how many lists the term at place ``i`` occurs, a word or a pair with a space between."""
    seen = np.zeros(len(terms), np.int64)
    for cells, _, _ in _term_cells(batches, terms):
        seen += np.bincount(cells % len(terms), minlength=len(terms))
    some = np.flatnonzero(seen)
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(seen[some])], ["i", "n"])


def document_cells(batches: Iterable[pa.RecordBatch], terms: list[str]) -> Iterator[pa.RecordBatch]:
    """(seq, place, n) of (tokens, seq): the places of a document's terms and how often they occur in it."""
    for cells, counts, part in _term_cells(batches, terms):
        of, place = np.divmod(cells, max(len(terms), 1))
        ends = pa.array(np.searchsorted(of, np.arange(part.num_rows + 1)), pa.int32())
        yield pa.RecordBatch.from_arrays([
            part.column(1), pa.ListArray.from_arrays(ends, pa.array(place, pa.int32())),
            pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
        ], ["seq", "place", "n"])


def unit_vectors(tokens: pa.Array, terms: list[str], idf: np.ndarray) -> pa.Array:
    """The weights of ``document_weights`` as sparse vectors of Spark's ML, one for each list."""
    batch = pa.RecordBatch.from_arrays([tokens, pa.array(np.arange(len(tokens)))], ["tokens", "seq"])
    ends, index, weight = np.zeros(len(tokens) + 1, np.int64), [np.empty(0, np.int32)], [np.empty(0)]
    for part in document_weights([batch], terms, idf):
        ends[part.column("seq").to_numpy() + 1] = part.column("index").value_lengths().to_numpy()
        index.append(part.column("index").flatten().to_numpy())
        weight.append(part.column("weight").flatten().to_numpy())
    ends = pa.array(np.cumsum(ends), pa.int32())
    return pa.StructArray.from_arrays([
        pa.array(np.zeros(len(tokens)), pa.int8()), pa.array(np.full(len(tokens), idf.size), pa.int32()),
        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(index), pa.int32())),
        pa.ListArray.from_arrays(ends, pa.array(np.concatenate(weight), pa.float64())),
    ], ["type", "size", "indices", "values"])


def document_weights(
    batches: Iterable[pa.RecordBatch], terms: list[str], idf: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """(seq, index, weight) of (tokens, seq): a document's terms in order, their weights scaled to length one.

    A document without any of ``terms`` has no row.
    """
    for cells, counts, part in _term_cells(batches, terms):
        of, place = np.divmod(cells, max(len(terms), 1))
        raw = counts * idf[place]
        sizes = np.bincount(of, minlength=part.num_rows)
        weight = raw / np.repeat(np.sqrt(np.bincount(of, raw * raw, part.num_rows)), sizes)
        some = np.flatnonzero(sizes)
        ends = pa.array(np.concatenate([[0], np.cumsum(sizes[some])]), pa.int32())
        yield pa.RecordBatch.from_arrays([
            part.column(1).take(pa.array(some)), pa.ListArray.from_arrays(ends, pa.array(place, pa.int32())),
            pa.ListArray.from_arrays(ends, pa.array(weight)),
        ], ["seq", "index", "weight"])


def in_blocks(
    batches: Iterable[pa.RecordBatch], starts: np.ndarray, blocks: np.ndarray
) -> Iterator[pa.RecordBatch]:
    """``batches`` with ``block``: that of the last of the sorted ``starts`` not beyond the first column."""
    for batch in batches:
        at = np.searchsorted(starts, batch.column(0).to_numpy(zero_copy_only=False), side="right") - 1
        yield batch.append_column("block", pa.array(blocks[at]))


def postings(vectors: pa.Table) -> pa.Table:
    """(index, block, top, seqs, weights) of the (seq, index, weight, block) of one block, by index and number."""
    lists = vectors.column("index").combine_chunks()
    index = lists.flatten().to_numpy(zero_copy_only=False)
    weight = vectors.column("weight").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    seq = np.repeat(vectors.column("seq").to_numpy(), lists.value_lengths().to_numpy(zero_copy_only=False))
    order = np.lexsort((weight, seq, index))
    index, seq, weight = index[order], seq[order], weight[order]
    starts = np.flatnonzero(np.diff(index, prepend=-1))
    ends = pa.array(np.append(starts, index.size), pa.int32())
    return pa.table({
        "index": pa.array(index[starts], pa.int32()),
        "block": pa.repeat(vectors.column("block")[0], starts.size),
        "top": np.maximum.reduceat(weight, starts),
        "seqs": pa.ListArray.from_arrays(ends, pa.array(seq)),
        "weights": pa.ListArray.from_arrays(ends, pa.array(weight)),
    })
