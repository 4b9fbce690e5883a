"""Fill-in-middle transformation by displacement scatter.

A text of n code points is cut at two places; its prefix, middle and suffix are put
out in another order behind three markers:

    psm    ``<P>`` prefix ``<S>`` suffix ``<M>`` middle
    spm    ``<S>`` suffix ``<P>`` prefix ``<M>`` middle
    plain  the text itself

Method: the texts of a batch are one flat byte array.  A scan over the first bytes of
code points turns the cuts into byte positions.  All bytes of one part move by the
same distance, so a *difference array* holds, where a part begins, the change of the
distance; its cumulative sum is the displacement of every byte, and one numpy scatter
writes the outputs.  The markers are scattered into the gaps.  :func:`restore` finds
the markers of an output, builds the same kind of array over the restored text and
gathers every byte from where it was put.

Cuts and forms are decided by the sha256 of ``seed:doc_id`` (:func:`plan`), so they do
not depend on partitions or retries.

Defined results: a null text counts as empty; an empty text and a text that holds a
marker stay plain; a null id is the empty string in the hash; rows of equal id are cut
at equal hashes, each by its own length; an empty table gives an empty table.  All
input columns are kept, and added columns replace input columns of the same name.  A
batch is cut into slices of about 1 MB, so a task needs some 40 bytes per byte of a
slice or of its longest text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm import _words as W
from hourcast.llm._frames import fresh, quoted, without

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
MARK = len(PREFIX)
PLAIN, PSM, SPM = "plain", "psm", "spm"
FORMS = [PLAIN, PSM, SPM]
#: Of 100 texts, so many are cut, and of those so many are put out suffix first.
CUT_PERCENT, SPM_PERCENT = 90, 20

_BYTES = {m: np.frombuffer(m.encode(), np.uint8) for m in (PREFIX, SUFFIX, MIDDLE)}
_LETTERS = np.array([ord(m[1]) for m in (PREFIX, SUFFIX, MIDDLE)], np.uint8)


def plan(text: Column, doc_id: Column, seed: int = 1, cut_percent: int = CUT_PERCENT,
         spm_percent: int = SPM_PERCENT) -> dict[str, Column]:
    """``n``, ``form`` and the two cuts ``lo`` and ``hi`` (in code points) of a text."""
    text = F.coalesce(text, F.lit(""))
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)]
    n = F.char_length(text).cast("long")
    first, second = h[0] % (n + 1), h[1] % (n + 1)
    marked = F.lit(False)
    for marker in (PREFIX, SUFFIX, MIDDLE):
        marked = marked | F.contains(text, F.lit(marker))
    form = (F.when((n == 0) | marked | (h[2] % 100 >= cut_percent), PLAIN)
            .when(h[3] % 100 < spm_percent, SPM).otherwise(PSM))
    return {"n": n, "form": form, "lo": F.least(first, second), "hi": F.greatest(first, second)}


def displacement(size: int, positions: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Shift of each of ``size`` bytes: ``shifts[i]`` from ``positions[i]`` (ascending) on."""
    change = np.zeros(size + 1, np.int64)
    np.add.at(change, positions, np.diff(shifts, prepend=0))
    return np.cumsum(change[:size])


def scatter(data: np.ndarray, offsets: np.ndarray, form: np.ndarray, lo: np.ndarray, hi: np.ndarray):
    """(bytes, offsets) of the outputs of flat texts; ``form`` holds indices of FORMS."""
    begin, end = offsets[:-1], offsets[1:]
    at = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
    base = np.searchsorted(at, begin)
    cut_1, cut_2 = at[base + lo], at[base + hi]
    psm, spm = form == 1, form == 2
    marked = psm | spm
    p, m, s = cut_1 - begin, cut_2 - cut_1, end - cut_2
    out_offsets = np.concatenate([[0], np.cumsum(end - begin + 3 * MARK * marked)])
    to = out_offsets[:-1]
    whole = to - begin
    shift_p = whole + np.where(psm, MARK, np.where(spm, 2 * MARK + s, 0))
    shift_m = whole + np.where(marked, 3 * MARK + s, 0)
    shift_s = whole + np.where(psm, 2 * MARK - m, np.where(spm, MARK - p - m, 0))
    moved = displacement(len(data), np.stack([begin, cut_1, cut_2], 1).ravel(),
                         np.stack([shift_p, shift_m, shift_s], 1).ravel())
    out = np.empty(out_offsets[-1], np.uint8)
    out[np.arange(len(data)) + moved] = data
    for marker, where in ((PREFIX, np.where(psm, to, to + MARK + s)),
                          (SUFFIX, np.where(psm, to + MARK + p, to)),
                          (MIDDLE, to + 2 * MARK + p + s)):
        for i, byte in enumerate(_BYTES[marker]):
            out[where[marked] + i] = byte
    return out, out_offsets


def gather(out: np.ndarray, offsets: np.ndarray, form: np.ndarray):
    """(bytes, offsets) of the texts that outputs were made from, by their forms."""
    begin, end = offsets[:-1], offsets[1:]
    psm, spm = form == 1, form == 2
    marked = psm | spm
    found = np.flatnonzero((out[:-2] == ord("<")) & (out[2:] == ord(">")) & np.isin(out[1:-1], _LETTERS)) \
        if len(out) > 2 else np.zeros(0, np.int64)
    doc = np.searchsorted(offsets, found, side="right") - 1
    found = found[marked[doc] & (found + MARK <= end[doc])].reshape(-1, 3)
    second, third = begin.copy(), end.copy()
    second[marked], third[marked] = found[:, 1], found[:, 2]
    restored = np.concatenate([[0], np.cumsum(end - begin - 3 * MARK * marked)])
    to = restored[:-1]
    # where the parts begin in the output, and their lengths
    from_p = np.where(psm, begin + MARK, np.where(spm, second + MARK, begin))
    from_s = np.where(psm, second + MARK, np.where(spm, begin + MARK, end))
    from_m = np.where(marked, third + MARK, end)
    p = np.where(psm, second - from_p, np.where(spm, third - from_p, end - begin))
    m = end - from_m
    moved = displacement(restored[-1], np.stack([to, to + p, to + p + m], 1).ravel(),
                         np.stack([from_p - to, from_m - to - p, from_s - to - p - m], 1).ravel())
    return out[np.arange(restored[-1]) + moved], restored


def _forms(column: pa.Array) -> np.ndarray:
    return np.array([FORMS.index(x) for x in column.to_pylist()], np.int8)


def _transform(names: list[str], text: str, plan_names: list[str], restored: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, text):
                column = lambda name: part.column(part.schema.get_field_index(name))  # noqa: E731, B023
                n, form, lo, hi = (column(x) for x in plan_names)
                codes = _forms(form)
                cuts = [x.to_numpy() for x in (lo, hi)]
                data, offsets = W.flat(column(text))
                out, out_offsets = scatter(data, offsets, codes, *cuts)
                plain = pa.array(codes == 0)
                none = pa.scalar(None, pa.int64())
                added = [n, form, pc.if_else(plain, none, lo),
                         pc.if_else(plain, none, pc.subtract(hi, lo)),
                         W.strings(out, out_offsets)]
                if restored:
                    added.append(W.strings(*gather(out, out_offsets, codes)))
                yield pa.RecordBatch.from_arrays(
                    [*(column(x) for x in names), *added], [*names, *_added(restored)])
    return run


def _added(restored: bool) -> list[str]:
    return ["n", "form", "prefix_chars", "middle_chars", "output", *(["restored"] if restored else [])]


def transform(spark: SparkSession, docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = 1,
              cut_percent: int = CUT_PERCENT, spm_percent: int = SPM_PERCENT,
              restored: bool = False) -> DataFrame:
    """``docs`` with ``n`` (code points), ``form``, ``prefix_chars`` and ``middle_chars``
    (null if plain) and ``output``; ``restored`` adds the text that :func:`gather`
    rebuilds from output and form, in the same pass."""
    W.bounded_batches(spark)
    base = without(docs, *_added(restored))
    steps = plan(docs[text], docs[doc_id], seed, cut_percent, spm_percent)
    names = fresh(docs, "source_text", *steps)
    wide = docs.select(*[quoted(c) for c in base.columns], docs[text].alias(names[0]),
                       *[e.alias(x) for x, e in zip(names[1:], steps.values())])
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in base.schema.fields)
    schema += "n long, form string, prefix_chars long, middle_chars long, output string"
    return wide.mapInArrow(_transform(base.columns, names[0], names[1:], restored),
                           schema + (", restored string" if restored else ""))


def _restore(names: list[str], output: str, form: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in W.slices(batch, output):
                column = lambda name: part.column(part.schema.get_field_index(name))  # noqa: E731, B023
                data, offsets = W.flat(column(output))
                text = W.strings(*gather(data, offsets, _forms(column(form))))
                yield pa.RecordBatch.from_arrays([*(column(x) for x in names), text], [*names, "restored"])
    return run


def restore(spark: SparkSession, outputs: DataFrame, output: str = "output", form: str = "form") -> DataFrame:
    """``outputs`` with ``restored``, the texts rebuilt from outputs and forms alone."""
    W.bounded_batches(spark)
    base = without(outputs, "restored")
    schema = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in base.schema.fields)
    return base.mapInArrow(_restore(base.columns, output, form), schema + "restored string")
