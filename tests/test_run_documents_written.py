"""Run documents written from rows, and their shape found by array operations."""

import glob
import json

from pyspark.sql import functions as F

from replyloom.plans.route_queries import _write_documents
from replyloom.sources import documents


def test_each_document_is_one_object_even_if_ids_repeat(spark):
    ids = [1, 1, 2, 3999, 4000, 9000, 9000, None]
    rows = spark.createDataFrame([(i, (f'}} "{n}" \\ é',)) for n, i in enumerate(ids)], "request_id bigint, row struct<note string>".replace("note string", "note: string"))
    path = _write_documents(spark, rows, "m").removeprefix("file:")
    docs = [json.load(open(f, encoding="utf-8")) for f in glob.glob(f"{path}/doc=*/*.txt")]
    assert sorted(len(x["results"]) for x in docs) == [1, 2, 4] and {x["mode"] for x in docs} == {"m"}
    elements, fields = documents.array_elements(spark, path)
    notes = {json.loads(r.text)["note"] for r in elements.collect()}
    assert notes == {f'}} "{n}" \\ é' for n in range(7)}
    assert fields.filter(F.col("key") == "mode").count() == 3


def test_shape_over_segments_with_escapes(monkeypatch):
    rows = [{"a": '\\"}{' * (i % 5), "b": [i, {"c": "é\\\\"}], "d": "\\" * i} for i in range(40)]
    text = json.dumps({"mode": "x\\\"", "config": {"l": ["results", {}]}, "results": rows, "model": "y"}, ensure_ascii=False)
    for size in (1, 2, 7, 64, 1 << 20):
        monkeypatch.setattr(documents, "_SEGMENT", size)
        *got, end = documents._cut(text, False, 0, "results")
        assert [json.loads(x[5]) for x in got if x[0] == "part"] == rows
        assert [json.loads(x[5]) for x in got if x[0] == "field"] == [["mode", "x\\\""], ["model", "y"]]
        assert documents._ends(text, False) == (False, 0) and end[3] is False
