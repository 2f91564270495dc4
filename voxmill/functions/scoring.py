"""Scores of many queries against one chunk of documents: runs in the Python workers."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

#: Bounds and similarities are sums of the same numbers in another order.
SLACK = 1e-9
#: Weights whose squares bound what a document can give: about as many as a query has terms.
LARGEST = 16


class _Chunk:
    """Cells of a chunk by term and document, the documents numbered by ``mass``, largest first.

    ``mass`` is the sum of a document's ``LARGEST`` largest squared weights.
    """

    def __init__(self, postings: pa.Table):
        lists = postings.column("seqs").combine_chunks()
        seqs, doc = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
        sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
        weight = postings.column("weights").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        squares = weight * weight
        by_size = np.argsort(doc - squares / (2 * squares.max(initial=1e-300)))
        cells = np.bincount(doc, minlength=seqs.size)
        nth = np.arange(doc.size) - np.repeat(np.cumsum(cells) - cells, cells)
        some = by_size[nth < LARGEST]
        mass = np.bincount(doc[some], squares[some], seqs.size)
        order = np.argsort(-mass, kind="stable")
        place = np.empty(order.size, np.int64)
        place[order] = np.arange(order.size)
        key = np.repeat(postings.column("index").to_numpy().astype(np.int64), sizes) * order.size + place[doc]
        by_key = np.argsort(key, kind="stable")
        key, weight = key[by_key], weight[by_key]
        self.seqs, self.mass, self.size = seqs[order], mass[order], order.size
        if (key[1:] == key[:-1]).any():  # rows of one number are one document, with larger weights
            self.mass = np.full(order.size, np.inf)
        self.key, self.weight, self.doc = key, weight, key % order.size

    def reach(self, least: np.ndarray, terms: np.ndarray) -> np.ndarray:
        """How many documents may be as similar as ``least`` to a query of so many ``terms`` and length one.

        A query gives no more than the length of what a document has of its terms. The squares of more than
        ``LARGEST`` weights are as large on average at most.
        """
        needed = np.maximum(least - SLACK, 0.0) ** 2 / np.maximum(terms / LARGEST, 1.0)
        return np.searchsorted(-self.mass, SLACK - needed, side="right")


def best_of_chunk(postings: pa.Table, terms: pa.Table, top_k: int) -> pa.Table:
    """(query_no, seq, sim): each query's ``top_k`` best documents of the chunk, ties to the later one.

    ``postings`` is (index, seqs, weights) of the chunk, ``terms`` (query_no, index, query_weight, least). One
    query is scored at a time, so the sums of a single query over the chunk are all that is held. Documents
    below ``least`` are left out (null: none), most of them before they are scored.
    """
    numbers = terms.column("query_no").combine_chunks()
    out = pa.schema([("query_no", numbers.type), ("seq", pa.int64()), ("sim", pa.float64())])
    if not postings.num_rows or not terms.num_rows:
        return out.empty_table()
    chunk = _Chunk(postings)
    query = numbers.dictionary_encode().indices.to_numpy()
    by_query = np.lexsort((terms.column("index").to_numpy(), query))
    index = terms.column("index").to_numpy()[by_query].astype(np.int64)
    query_weight = terms.column("query_weight").to_numpy()[by_query]
    edges = np.flatnonzero(np.diff(query[by_query], prepend=-1, append=-1))
    starts, sizes = edges[:-1], np.diff(edges)
    least = terms.column("least").to_numpy(zero_copy_only=False).astype(np.float64)[by_query][starts]
    length = np.sqrt(np.add.reduceat(query_weight * query_weight, starts))
    floor = np.nan_to_num(least, nan=0.0) - SLACK
    reach = chunk.reach(floor / length, sizes)
    # The cells of a term are sorted by document, so those within reach are the first of them.
    first = np.searchsorted(chunk.key, index * chunk.size)
    last = np.searchsorted(chunk.key, index * chunk.size + np.repeat(reach, sizes))
    rows, found, sims = [], [], []
    for n in np.flatnonzero(np.logical_or.reduceat(last > first, starts)):
        cells = [(first[i], last[i], query_weight[i]) for i in range(edges[n], edges[n + 1]) if first[i] < last[i]]
        sim = np.bincount(
            np.concatenate([chunk.doc[a:b] for a, b, _ in cells]),
            np.concatenate([chunk.weight[a:b] * w for a, b, w in cells]), reach[n],
        )
        docs = np.flatnonzero(sim >= max(floor[n], SLACK / 100))
        level = np.round(sim[docs], 10)
        keep = level > 0
        if np.count_nonzero(keep) > top_k:
            keep &= level >= np.partition(level, -top_k)[-top_k]
        docs, level = docs[keep], level[keep]
        best = docs[np.lexsort((-chunk.seqs[docs], -level))[:top_k]]
        rows.append(np.full(best.size, by_query[edges[n]]))
        found.append(chunk.seqs[best])
        sims.append(sim[best])
    if not rows:
        return out.empty_table()
    return pa.table(
        [numbers.take(pa.array(np.concatenate(rows))), np.concatenate(found), np.concatenate(sims)], schema=out
    )
