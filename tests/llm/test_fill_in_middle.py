"""Operator 11 against plain Python string slicing."""

import hashlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import collected, no_documents, odd_documents, rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crawlweave.llm import fill_in_middle as fim
from crawlweave.llm.queries import op11_fill_in_middle


def expected(doc_id, text, units=list, seed=1, marks=fim.SENTINELS):
    text = text or ""
    h = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[8 * i:8 * i + 8], 16) for i in range(4))
    u = units(text)
    n = len(u)
    if not n or any(m in text for m in marks) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b, c = "".join(u[:i]), "".join(u[i:j]), "".join(u[j:])
    p, s, m = marks
    if h4 % 100 < 20:
        return n, "spm", i, j - i, s + c + p + a + m + b
    return n, "psm", i, j - i, p + a + s + c + m + b


def lines(text):
    return [x + "\n" for x in text.split("\n")[:-1]] + ([text.split("\n")[-1]] if text.split("\n")[-1] else [])


@pytest.mark.parametrize(("unit", "units"), [("char", list), ("line", lines)])
def test_odd_documents(spark, unit, units):
    made = fim.fill_in_middle(odd_documents(spark), unit=unit)
    out = collected(made.withColumn("restored", fim.restore(F.col("output"), F.col("form"))))
    got = sorted((repr(r["doc_id"]), r["n"], r["form"], r["prefix_units"], r["middle_units"], r["output"],
                  r["restored"]) for r in out)
    want = sorted((repr(r[0]), *expected(r[0], r[1], units), r[1] or "") for r in rows())
    assert repr(got) == repr(want)


def test_all_forms_and_marks_inside_texts(spark):
    texts = ["x<P>y", "<S>", "a<M", "<P", ">", "<<", "ends with <", "P>", "é<S", "中文" * 50]
    data = [(i, texts[i % len(texts)]) for i in range(300)]
    made = fim.fill_in_middle(spark.createDataFrame(data, "doc_id long, text string"))
    out = collected(made.withColumn("restored", fim.restore(F.col("output"), F.col("form"))))
    assert {r["form"] for r in out} == {"plain", "psm", "spm"}
    by_id = dict(data)
    for r in out:
        assert (r["n"], r["form"], r["prefix_units"], r["middle_units"], r["output"]) == expected(
            r["doc_id"], by_id[r["doc_id"]])
        assert r["restored"] == by_id[r["doc_id"]]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="a\né中\U0001f600 ", max_size=40), st.integers(0, 45), st.integers(0, 45)),
                max_size=8), st.integers(1, 30), st.sampled_from(fim.UNITS))
def test_pieces_over_slabs_of_any_size(cases, slab, unit):
    cut = list if unit == "char" else lines
    units = [cut(t) for t, _, _ in cases]
    first = np.array([min(i, j, len(u)) for u, (_, i, j) in zip(units, cases, strict=True)], np.int64)
    second = np.array([min(max(i, j), len(u)) for u, (_, i, j) in zip(units, cases, strict=True)], np.int64)
    texts = pa.array([t for t, _, _ in cases], pa.string())
    assert fim.count_units(texts, unit).to_pylist() == [len(u) for u in units]
    got = [p.to_pylist() for p in fim.pieces(texts, first, second, unit, slab)]
    assert got == [["".join(u[:i]) for u, i in zip(units, first, strict=True)],
                   ["".join(u[i:j]) for u, i, j in zip(units, first, second, strict=True)],
                   ["".join(u[j:]) for u, j in zip(units, second, strict=True)]]


def test_very_long_text(spark):
    text = "ab é中\n" * 700_000  # over several slabs
    made = fim.fill_in_middle(spark.createDataFrame([(3, text), (4, "short")], "doc_id long, text string"))
    got = {r["doc_id"]: (r["n"], r["form"], r["prefix_units"], r["middle_units"], r["output"])
           for r in collected(made)}
    assert got == {3: expected(3, text), 4: expected(4, "short")}
    assert got[3][1] != "plain"


def test_empty_table_and_names(spark):
    assert collected(fim.fill_in_middle(no_documents(spark))) == []
    with pytest.raises(ValueError):
        fim.fill_in_middle(no_documents(spark), sentinels=("<P>", "<PS>", "<P>"))
    with pytest.raises(ValueError):
        fim.fill_in_middle(no_documents(spark), sentinels=("<P>", "a<", "<M>"))
    with pytest.raises(ValueError):
        fim.fill_in_middle(no_documents(spark).withColumnRenamed("doc_id", "output"), id_col="output")
    # other columns may bear the names of the output
    clash = no_documents(spark).withColumnRenamed("kept", "output").withColumnRenamed("ids", "n")
    assert fim.fill_in_middle(clash).columns == ["doc_id", "n", "form", "prefix_units", "middle_units", "output"]


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = collected(op11_fill_in_middle(spark, sf))
    assert len(out) == len(docs)
    for r in out:
        n, form, prefix, middle, output = expected(r["doc_id"], docs[r["doc_id"]])
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, prefix, middle)
        assert r["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        assert r["restored_sha256"] == hashlib.sha256((docs[r["doc_id"]] or "").encode()).hexdigest()
