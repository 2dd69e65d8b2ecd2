"""JSON array files that the executors write."""

import pyarrow as pa
from pyspark.sql import functions as F

from agentlake import fixtures as fx


def test_array_files_are_written_batch_by_batch(tmp_path):
    """A file's beginning is in place before its last elements are asked for; files may begin and end inside batches."""
    rows = [("app-1/a.json", f'{{"n": "{"é" * 50}{k}"}}') for k in range(9)] + [("app-1/b.json", "1"), ("app-2/a.json", "[]"), ("app-2/a.json", "2")]
    seen = []

    def batches():
        for at in range(0, len(rows), 4):
            first = tmp_path / "app-1/a.json"
            seen.append(first.stat().st_size if first.exists() else 0)
            yield pa.RecordBatch.from_pydict({"path": [p for p, _ in rows[at : at + 4]], "element": [e for _, e in rows[at : at + 4]]})

    found = [p for batch in fx._write_sorted(batches(), f"file://{tmp_path}", ",\n") for p in batch.column("path").to_pylist()]
    assert found == ["app-1/a.json", "app-1/b.json", "app-2/a.json"]
    for path in found:
        assert (tmp_path / path).read_text() == "[" + ",\n".join(e for p, e in rows if p == path) + "]"
    assert seen[0] == 0 and 400 < seen[1] < seen[2]


def test_array_files_keep_the_order_of_places(spark, tmp_path):
    """Also where the rows of a file are more than a batch; missing places come first, parts of a path may be missing."""
    rows = [(None if k % 5 == 4 else "app-1", None if k % 3 == 2 else k % 3, None if k == 7 else 600 - k // 2, str(k)) for k in range(900)]
    df = spark.createDataFrame(rows, "app STRING, conv INT, place INT, element STRING").repartition(7)
    size = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 64)
    try:
        fx.write_arrays(df.withColumn("path", F.concat_ws("/", "app", F.col("conv").cast("string"), F.lit("x.json"))), str(tmp_path / "tree"), ", ")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
    files = {}
    for app, conv, place, element in sorted(rows, key=lambda r: (r[2] is not None, r[2], r[3])):
        files.setdefault("/".join(str(x) for x in (app, conv, "x.json") if x is not None), []).append(element)
    assert {str(p.relative_to(tmp_path / "tree")): p.read_text() for p in (tmp_path / "tree").rglob("x.json")} == {p: f"[{', '.join(e)}]" for p, e in files.items()}
