"""Fill-in-middle: documents cut at token borders and put into training order.

A text of n tokens (a word with the white space before it, or white space at the end) is cut twice.
Form ``psm`` is ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, ``spm`` is ``<S>`` suffix ``<P>`` prefix
``<M>`` middle, ``plain`` is the text itself.

Displacement scatter. The bytes of many texts are one array. Every part of a text moves by some
distance; a difference array holds by how much that distance changes where a part begins, its
running sum is the shift of each byte, and one scatter writes all bytes. ``restore`` looks for the
marks in the output, makes the shifts the other way and gathers. Both go over the bytes a step at
a time, so that a worker holds the text, the output and one step of shifts.

Which form a document takes and where it is cut depends on its id alone. Null texts count as empty,
empty texts and texts that hold a mark stay plain. A null id is hashed as an empty string; repeated
rows give equal rows. Columns of any name may stand beside: only those in ``keep`` are carried, under
their own names. An empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from voxmill.sources.shipping import ship_package

SEED = 42
#: Of 100 documents, so many are cut; of 100 cut ones, so many take the form ``spm``.
CUT_SHARE, SPM_SHARE = 50, 80
#: Texts are taken together up to this many bytes; a longer text stands alone.
BLOCK_BYTES = 4 << 20
#: Bytes that are moved at a time.
STEP_BYTES = 1 << 20

FORMS = ("plain", "psm", "spm")
PLAIN, PSM, SPM = range(3)
_LETTERS = b"PSM"
#: The marks of each form in their order, as places in ``_LETTERS``.
_ORDER = {PSM: (0, 1, 2), SPM: (1, 0, 2)}


def token_ends(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(where tokens end, for each text the number of tokens before it; the last entry is the total)"""
    white = (data == 32) | ((data >= 9) & (data <= 13))
    ends = np.zeros(len(data), bool)
    ends[:-1] = ~white[:-1] & white[1:]
    ends[offsets[1:][offsets[1:] > offsets[:-1]] - 1] = True
    # A word's last byte may have been marked as the text before ended: both say the same place.
    places = np.flatnonzero(ends) + 1
    return places, np.searchsorted(places, offsets, side="right")


def marks(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, text, letter) of every mark that lies within a text."""
    at = np.flatnonzero(data[:-2] == ord("<")) if len(data) > 2 else np.zeros(0, np.int64)
    at = at[data[at + 2] == ord(">")]
    letter = np.full(256, -1)
    letter[list(_LETTERS)] = range(3)
    found = letter[data[at + 1]]
    at, found = at[found >= 0], found[found >= 0]
    text = np.searchsorted(offsets, at, side="right") - 1
    whole = at + 3 <= offsets[text + 1]
    return at[whole], text[whole], found[whole]


def _moved(source: np.ndarray, size: int, starts: np.ndarray, shifts: np.ndarray, gather: bool) -> np.ndarray:
    """Scatter ``source`` into ``size`` bytes, or gather so many from it.

    Byte ``i`` of the side that is gone through in order has the shift of the last part that starts at
    or before ``i``. ``starts`` rises; of parts that start together the last one holds.
    """
    change = np.diff(shifts, prepend=0)
    out = np.empty(size, np.uint8)
    total, carry = size if gather else len(source), 0
    for low in range(0, total, STEP_BYTES):
        high = min(total, low + STEP_BYTES)
        a, b = np.searchsorted(starts, (low, high))
        shift = np.zeros(high - low, np.int64)
        np.add.at(shift, starts[a:b] - low, change[a:b])
        shift[0] += carry
        np.cumsum(shift, out=shift)
        carry = int(shift[-1])
        shift += np.arange(low, high)
        if gather:
            out[low:high] = source[shift]
        else:
            out[shift] = source[low:high]
    return out


def scatter(
    data: np.ndarray, offsets: np.ndarray, hashes: np.ndarray,
    cut_share: int = CUT_SHARE, spm_share: int = SPM_SHARE,
) -> tuple[np.ndarray, ...]:
    """(output bytes, output offsets, forms, token counts, first cuts, second cuts) of all texts.

    ``hashes``: four unsigned numbers a text. Cuts are places in ``data``.
    """
    ends, before = token_ends(data, offsets)
    n = np.diff(before)
    start, end = offsets[:-1], offsets[1:]
    size = end - start
    form = np.where(hashes[:, 2] % 100 >= cut_share, PLAIN, np.where(hashes[:, 3] % 100 < spm_share, SPM, PSM))
    form[size == 0] = PLAIN
    form[marks(data, offsets)[1]] = PLAIN
    units = np.sort(hashes[:, :2] % (n + 1)[:, None], axis=1).astype(np.int64)
    cuts = np.where(units == 0, start[:, None], np.append(ends, 0)[before[:-1, None] + units - 1])
    first, second = np.where(form == PLAIN, end, cuts[:, 0]), np.where(form == PLAIN, end, cuts[:, 1])

    prefix, suffix = first - start, end - second
    grown = size + np.where(form == PLAIN, 0, 9)
    to = np.concatenate(([0], np.cumsum(grown)))
    at = to[:-1]
    # Where prefix, middle and suffix go.
    spm = form == SPM
    prefix_to = at + np.where(form == PLAIN, 0, np.where(spm, 6 + suffix, 3))
    middle_to = at + np.where(form == PLAIN, size, 9 + prefix + suffix)
    suffix_to = at + np.where(form == PLAIN, size, np.where(spm, 3, 6 + prefix))
    starts = np.stack([start, first, second], axis=1).ravel()
    shifts = np.stack([prefix_to - start, middle_to - first, suffix_to - second], axis=1).ravel()
    out = _moved(data, int(to[-1]), starts, shifts, gather=False)
    cut = form != PLAIN
    for letter, place in zip(_LETTERS, (prefix_to, suffix_to, middle_to)):
        for j, byte in enumerate((ord("<"), letter, ord(">"))):
            out[place[cut] - 3 + j] = byte
    return out, to, form, n, first, second


def gather(data: np.ndarray, offsets: np.ndarray, form: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts that outputs ``data`` of the given forms were made from."""
    at, text, letter = marks(data, offsets)
    own = form[text] != PLAIN
    at, text, letter = at[own], text[own], letter[own]
    cut = np.flatnonzero(form != PLAIN)
    wanted = np.array([_ORDER.get(f, ()) for f in form[cut].tolist()], np.int64).reshape(-1, 3)
    if not (np.array_equal(text, np.repeat(cut, 3)) and np.array_equal(letter, wanted.ravel())):
        raise ValueError("an output does not hold the marks of its form")
    begin, end = offsets[:-1], offsets[1:]
    size = np.diff(offsets) - np.where(form == PLAIN, 0, 9)
    to = np.concatenate(([0], np.cumsum(size)))
    # By letter: where each part lies in the output, and how long it is.
    place = np.tile(end[:, None], (1, 3))
    length = np.zeros((len(form), 3), np.int64)
    place[form == PLAIN, 0], length[form == PLAIN, 0] = begin[form == PLAIN], size[form == PLAIN]
    if len(cut):
        own_at = at.reshape(-1, 3)
        stop = np.concatenate([own_at[:, 1:], end[cut, None]], axis=1)
        row = np.repeat(cut, 3).reshape(-1, 3)
        place[row, wanted] = own_at + 3
        length[row, wanted] = stop - own_at - 3
    prefix, suffix, middle = place.T
    first = to[:-1] + length[:, 0]
    second = first + length[:, 2]
    starts = np.stack([to[:-1], first, second], axis=1).ravel()
    shifts = np.stack([prefix - to[:-1], middle - first, suffix - second], axis=1).ravel()
    return _moved(data, int(to[-1]), starts, shifts, gather=True), to


# Jobs


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a column of strings; nulls are empty."""
    column = column.cast(pa.large_string()).fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return bytes_[at[0]:at[-1]], at - at[0]


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    made = pa.Array.from_buffers(
        pa.large_string(), len(offsets) - 1, [None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data)]
    )
    return made.cast(pa.string())


def _map_blocks(
    df: DataFrame, keep: list[str], inputs: list[Column], made: list[T.StructField], work: Callable[..., list[pa.Array]],
) -> DataFrame:
    """Columns ``keep`` plus those that ``work(texts' bytes, offsets, other inputs)`` makes.

    The first of ``inputs`` is the text; rows come together in blocks of ``BLOCK_BYTES``, by whole texts.
    """
    ship_package(df.sparkSession)
    inner = [T.StructField(f"_{i}", df.schema[c].dataType) for i, c in enumerate(keep)]
    schema = T.StructType([*inner, *(T.StructField(f"+{f.name}", f.dataType) for f in made)])
    target, kept = to_arrow_schema(schema), len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = _flat(batch.column(kept))[1]
            low = 0
            while low < batch.num_rows:
                high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + BLOCK_BYTES, side="right")) - 1)
                part = batch.slice(low, high - low)
                data, at = _flat(part.column(kept))
                found = work(data, at, *part.columns[kept + 1:])
                columns = [c.cast(f.type) for c, f in zip([*part.columns[:kept], *found], target)]
                yield pa.RecordBatch.from_arrays(columns, schema=target)
                low = high

    picked = df.select(
        *(F.col(c).alias(f"_{i}") for i, c in enumerate(keep)), *(c.alias(f"_in{i}") for i, c in enumerate(inputs))
    )
    out = picked.mapInArrow(run, schema)
    return out.select(
        *(F.col(f"_{i}").alias(c) for i, c in enumerate(keep)), *(F.col(f"+{f.name}").alias(f.name) for f in made)
    )


def _seeds(id_: Column, seed: int) -> Column:
    """Four unsigned 32-bit numbers, as 16 bytes, most significant first."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit("")))
    return F.unhex(F.substring(F.sha2(name, 256), 1, 32))


def _numbers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), ">u4").astype(np.int64).reshape(-1, 4)


_CUT = [
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_chars", T.LongType()), T.StructField("middle_chars", T.LongType()),
]


def _described(data, form, n, offsets, first, second) -> list[pa.Array]:
    lead = (data & 0xC0) != 0x80
    count = lambda low, high: [
        None if f == PLAIN else int(np.count_nonzero(lead[a:b])) for f, a, b in zip(form.tolist(), low.tolist(), high.tolist())
    ]
    return [
        pa.array(n, pa.int64()), pa.array([FORMS[f] for f in form.tolist()]),
        pa.array(count(offsets[:-1], first), pa.int64()), pa.array(count(first, second), pa.int64()),
    ]


def transform(
    docs: DataFrame, keep: list[str], text: str = "text", id_: str = "doc_id", seed: int = SEED,
    cut_share: int = CUT_SHARE, spm_share: int = SPM_SHARE,
) -> DataFrame:
    """Columns ``keep`` plus ``n, form, prefix_chars, middle_chars`` and the ``output``. No shuffle."""

    def work(data, offsets, seeds):
        out, to, form, n, first, second = scatter(data, offsets, _numbers(seeds), cut_share, spm_share)
        return [*_described(data, form, n, offsets, first, second), _strings(out, to)]

    made = [*_CUT, T.StructField("output", T.StringType())]
    return _map_blocks(docs, keep, [F.col(text), _seeds(F.col(id_), seed)], made, work)


def restore(made: DataFrame, keep: list[str], output: str = "output", form: str = "form") -> DataFrame:
    """Columns ``keep`` plus the ``text`` that each output was made from."""

    def work(data, offsets, forms):
        codes = np.array([FORMS.index(f) for f in forms.to_pylist()], np.int64)
        return [_strings(*gather(data, offsets, codes))]

    return _map_blocks(made, keep, [F.col(output), F.col(form)], [T.StructField("text", T.StringType())], work)


def _digests(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    view, at = memoryview(data), offsets.tolist()
    return pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in zip(at, at[1:])], pa.string())


def query(docs: DataFrame) -> DataFrame:
    """``transform`` and, from its output and form alone, ``restore``, as digests."""

    def work(data, offsets, seeds):
        out, to, form, n, first, second = scatter(data, offsets, _numbers(seeds))
        rows = _described(data, form, n, offsets, first, second)
        return [*rows, _digests(out, to), _digests(*gather(out, to, form))]

    made = [*_CUT, T.StructField("output_sha256", T.StringType()), T.StructField("restored_sha256", T.StringType())]
    return _map_blocks(docs, ["doc_id"], [F.col("text"), _seeds(F.col("doc_id"), SEED)], made, work)


ORACLE = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id) AS x FROM documents),
u AS (
  SELECT doc_id, t, regexp_extract_all(t, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w,
         CAST('0x' || x[1:8] AS BIGINT) AS h1, CAST('0x' || x[9:16] AS BIGINT) AS h2,
         CAST('0x' || x[17:24] AS BIGINT) AS h3, CAST('0x' || x[25:32] AS BIGINT) AS h4 FROM h),
c AS (
  SELECT *, len(w) AS n, least(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS a,
         greatest(h1 % (len(w) + 1), h2 % (len(w) + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR h3 % 100 >= 50 THEN 'plain'
              WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (
  SELECT *, array_to_string(list_slice(w, 1, a), '') AS prefix,
         array_to_string(list_slice(w, a + 1, b), '') AS middle,
         array_to_string(list_slice(w, b + 1, n), '') AS suffix FROM c)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
              WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
