"""Operator 11: fill-in-middle transformation as a pyarrow.compute pipeline.

Each text is cut into units (code points, or lines with their line feed).
Per batch the units form a list array; it is flattened with parent indices,
every unit gets its ordinal in its text, the units are filtered by role
(prefix, middle, suffix), the lists are rebuilt and joined into pieces, and
the pieces are joined with the sentinels.  Texts pass through in slabs of
SLAB_BYTES, so that memory does not grow with the length of a text beyond the
text itself and its output.

The cuts come from the sha256 of ``<seed>:<id>``, whose first four groups of 8
hex digits are h1 to h4: prefix up to the smaller, middle up to the larger of
``h1 % (n + 1)`` and ``h2 % (n + 1)`` units.  A text stays plain if it is empty,
holds a sentinel or ``h3 % 100`` is in the last ``plain_percent``; of the others
those with ``h4 % 100 < spm_percent`` are in the form suffix, prefix, middle.

Null texts count as empty.  A null id hashes as an empty one.  Repeated rows
and ties of ids give equal results.  An empty table gives no rows.  Columns
other than the id and the text are not read, so their names cannot clash; an
id column named like an output column is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from crawlweave.llm.common import prepare, text_parts

SENTINELS = ("<P>", "<S>", "<M>")
#: Bytes of text whose units are in one list array (a longer unit goes alone).
SLAB_BYTES = 1 << 20
UNITS = ("char", "line")
_OUT = ["n", "form", "prefix_units", "middle_units", "output"]


def unit_starts(raw: np.ndarray, unit: str) -> np.ndarray:
    """True at each byte that starts a unit, for a slab that starts with one."""
    if unit == "char":
        return (raw & 0xC0) != 0x80
    starts = np.empty(len(raw), bool)
    starts[:1] = True
    starts[1:] = raw[:-1] == 10
    return starts


def count_units(texts: pa.Array, unit: str) -> pa.Array:
    if unit == "char":
        return pc.cast(pc.utf8_length(texts), pa.int64())
    open_end = pc.and_(pc.greater(pc.binary_length(texts), 0), pc.invert(pc.ends_with(texts, "\n")))
    return pc.add(pc.cast(pc.count_substring(texts, "\n"), pa.int64()), pc.cast(open_end, pa.int64()))


def _slabs(offsets: np.ndarray, raw: np.ndarray, unit: str, slab: int) -> Iterator[list[tuple[int, int, int]]]:
    """Runs of segments (text, first byte, end byte) of about ``slab`` bytes; a longer text gives several segments."""
    run, held = [], 0
    for i in range(len(offsets) - 1):
        begin, end = int(offsets[i]), int(offsets[i + 1])
        while begin < end:
            stop = min(end, begin + slab - held)
            if stop < end:  # on to the next start of a unit
                step = 4 if unit == "char" else slab
                at = stop
                while at < end:
                    found = np.flatnonzero(unit_starts(raw[at - 1:at + step], unit)[1:])
                    if len(found):
                        at += int(found[0])
                        break
                    at += step
                stop = min(at, end)
            run.append((i, begin, stop))
            held += stop - begin
            begin = stop
            if held >= slab:
                yield run
                run, held = [], 0
    if run:
        yield run


def pieces(texts: pa.Array, first: np.ndarray, second: np.ndarray, unit: str = "char",
           slab: int = SLAB_BYTES) -> list[pa.Array]:
    """Prefix, middle and suffix of each text: units before ``first``, before ``second``, and the rest."""
    texts = texts if texts.offset == 0 else pa.concat_arrays([texts])
    count = len(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int32)[:count + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    seen = np.zeros(count, np.int64)  # units of each text in earlier segments
    owners: list[np.ndarray] = []
    parts: list[list[pa.Array]] = [[], [], []]
    for run in _slabs(offsets, raw, unit, slab):
        text, begin, end = (np.array(x, np.int64) for x in zip(*run, strict=True))
        low, high = int(begin[0]), int(end[-1])
        starts = np.flatnonzero(unit_starts(raw[low:high], unit) | _at(begin - low, high - low))
        unit_offsets = np.append(starts, high - low).astype(np.int32)
        flat = pa.StringArray.from_buffers(len(starts), pa.py_buffer(unit_offsets), data.slice(low, high - low))
        bounds = np.append(np.searchsorted(starts, begin - low), len(starts)).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), flat)

        units = pc.list_flatten(lists)
        parent = pc.list_parent_indices(lists)
        opened = pa.array(bounds[:-1].astype(np.int64) - seen[text])
        ordinal = pc.subtract(pa.array(np.arange(len(starts), dtype=np.int64)), pc.take(opened, parent))
        in_prefix = pc.less(ordinal, pc.take(pa.array(first[text]), parent))
        in_suffix = pc.greater_equal(ordinal, pc.take(pa.array(second[text]), parent))
        in_middle = pc.invert(pc.or_(in_prefix, in_suffix))
        for role, mask in enumerate((in_prefix, in_middle, in_suffix)):
            of = pc.filter(parent, mask).to_numpy(zero_copy_only=False)
            rebuilt = np.append(0, np.cumsum(np.bincount(of, minlength=len(run)))).astype(np.int32)
            parts[role].append(pc.binary_join(
                pa.ListArray.from_arrays(pa.array(rebuilt, pa.int32()), pc.filter(units, mask)), ""))
        # a text runs over at most one border of the slab
        np.add.at(seen, text, np.diff(bounds))
        owners.append(text)
    if not owners:
        return [pa.array([""] * count, pa.string())] * 3
    owner = np.concatenate(owners)
    of_text = pa.array(np.searchsorted(owner, np.arange(count + 1)).astype(np.int32))
    return [pc.binary_join(pa.ListArray.from_arrays(of_text, pa.concat_arrays(p)), "") for p in parts]


def _at(places: np.ndarray, size: int) -> np.ndarray:
    out = np.zeros(size, bool)
    out[places] = True
    return out


def _check_sentinels(sentinels: tuple[str, str, str]) -> None:
    """A sentinel must not arise where pieces meet: no first character of one elsewhere in any of them."""
    heads = {s[:1] for s in sentinels}
    if len(set(sentinels)) < 3 or "" in sentinels or any(h in s[1:] for h in heads for s in sentinels):
        raise ValueError("sentinels: three different strings whose first characters occur nowhere else in them")


def fill_in_middle(df: DataFrame, seed: int = 1, plain_percent: int = 10, spm_percent: int = 20,
                   sentinels: tuple[str, str, str] = SENTINELS, unit: str = "char",
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``n`` units, ``form`` (plain, psm or spm), ``prefix_units``, ``middle_units`` (null if plain)
    and ``output``, one row per row of ``df``."""
    _check_sentinels(sentinels)
    if unit not in UNITS:
        raise ValueError(f"unit: one of {', '.join(UNITS)}")
    if id_col in _OUT:
        raise ValueError(f"the id column cannot be named {id_col}")
    prepare(df.sparkSession)
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(df[id_col].cast("string"), F.lit(""))), 256)
    hashed = df.select(df[id_col].alias("id"), df[text_col].alias("text"), key.alias("__h"))
    rows = hashed.select("id", "text", *[
        F.conv(F.substring("__h", 8 * i + 1, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)])
    kind = rows.schema["id"].dataType.simpleString()
    p, s, m = sentinels

    def transform(part: pa.RecordBatch) -> pa.RecordBatch:
        texts = pc.fill_null(part.column("text"), "")
        h1, h2, h3, h4 = (part.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4))
        n = count_units(texts, unit).to_numpy()
        cut1, cut2 = h1 % (n + 1), h2 % (n + 1)
        first, second = np.minimum(cut1, cut2), np.maximum(cut1, cut2)
        held = pc.or_(pc.or_(pc.match_substring(texts, p), pc.match_substring(texts, s)), pc.match_substring(texts, m))
        plain = (n == 0) | held.to_numpy(zero_copy_only=False) | (h3 % 100 >= 100 - plain_percent)
        spm = ~plain & (h4 % 100 < spm_percent)

        outputs = [texts.filter(pa.array(plain))]
        order = [np.flatnonzero(plain)]
        for chosen, first_marks in ((spm, (s, p)), (~plain & ~spm, (p, s))):
            mask = pa.array(chosen)
            prefix, middle, suffix = pieces(texts.filter(mask), first[chosen], second[chosen], unit)
            one, two = (suffix, prefix) if first_marks == (s, p) else (prefix, suffix)
            outputs.append(pc.binary_join_element_wise(first_marks[0], one, first_marks[1], two, m, middle, ""))
            order.append(np.flatnonzero(chosen))
        place = np.argsort(np.concatenate(order), kind="stable")
        output = pc.take(pa.concat_arrays(outputs), pa.array(place))
        form = pa.array(np.where(plain, "plain", np.where(spm, "spm", "psm")).tolist(), pa.string())
        return pa.RecordBatch.from_arrays(
            [part.column("id"), pa.array(n, pa.int64()), form, pa.array(first, pa.int64(), mask=plain),
             pa.array(second - first, pa.int64(), mask=plain), output], names=[id_col, *_OUT])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_parts(batch, "text"):
                yield transform(part)

    return rows.mapInArrow(run, f"`{id_col}` {kind}, n long, form string, prefix_units long, middle_units long, "
                                "output string")


def restore(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text, from the output and its form alone."""
    p, s, m = sentinels
    middle = F.substring_index(output, m, -1)
    head = F.substring_index(output, m, 1)  # both outer pieces, each behind its mark
    psm = F.concat(F.substr(F.substring_index(head, s, 1), F.lit(len(p) + 1)), middle,
                   F.substring_index(head, s, -1))
    spm = F.concat(F.substring_index(head, p, -1), middle,
                   F.substr(F.substring_index(head, p, 1), F.lit(len(s) + 1)))
    return F.when(form == "plain", output).when(form == "psm", psm).when(form == "spm", spm)
