"""Named text files: written in two phases, read back flat."""
import os
import uuid

import pytest
from pyspark.sql import functions as F

from tessera.operators import messages as mg
from tessera.session import scratch_dir
from tessera.sinks.named_files import write_named_files
from tessera.sources import files as fs


def folder(spark):
    return scratch_dir(spark, f"named_{uuid.uuid4().hex}")


def frame(spark, rows):
    return spark.createDataFrame(rows, "name string, text string").repartition(3)


def test_texts_come_back_as_they_were(spark):
    rows = [(f"{i}.md", t) for i, t in enumerate(["", "a", "a\n", "\n\n", "é😀\r\n tab\t", "x" * 100_000])]
    at = folder(spark)
    write_named_files(frame(spark, [*rows, ("none.md", None), ("other.txt", "t")]), at)
    got = {r.name: r.text for r in fs.read_text_docs(spark, at).collect()}
    assert got == {**dict(rows), "none.md": ""}
    write_named_files(frame(spark, [("0.md", "new"), ("9.md", "nine")]), "file:" + at)  # added to, one replaced
    got = {r.name: r.text for r in fs.read_text_docs(spark, at).collect()}
    assert got == {**dict(rows), "none.md": "", "0.md": "new", "9.md": "nine"}
    write_named_files(frame(spark, [("1.md", "only")]), at, mode="overwrite")
    assert os.listdir(at) == ["1.md"]


def test_sub_folders_are_not_entered(spark):
    at = folder(spark)
    write_named_files(frame(spark, [("a.md", "a")]), at)
    write_named_files(frame(spark, [("b.md", "b")]), f"{at}/sub")
    assert [r.name for r in fs.read_text_docs(spark, at).collect()] == ["a.md"]


@pytest.mark.parametrize("bad", ["twice.md", "a/b.md", "..", "_x.md", "", None])
def test_bad_names_leave_no_file(spark, bad):
    at = folder(spark)
    rows = [("first.md", "1"), ("twice.md", "2"), (bad, "3")]
    with pytest.raises(Exception, match="plain file name|two rows"):
        write_named_files(frame(spark, rows), at)
    # a task that ends after the abort may leave its hidden folder
    assert not os.path.exists(at) or [f for f in os.listdir(at) if f[0] != "_"] == []


def test_a_failed_task_leaves_no_file(spark):
    at = folder(spark)
    rows = spark.range(40).repartition(4).select(
        F.concat(F.col("id").cast("string"), F.lit(".md")).alias("name"),
        F.when(F.col("id") == 39, F.raise_error(F.lit("lost"))).otherwise("t").alias("text"))
    with pytest.raises(Exception, match="lost"):
        write_named_files(rows, at)
    assert not os.path.exists(at) or [f for f in os.listdir(at) if not f.startswith("_")] == []
    assert fs.read_text_docs(spark, at).count() == 0 if os.path.exists(at) else True


def test_ndjson_lines_keep_their_order(spark):
    at = folder(spark)
    rows = [(b, p, f'{{"p":{p}}}') for b in (1, 2) for p in (3, 1, 2)]
    mg.write_ndjson(spark.createDataFrame(rows, "batch_id long, pos long, line string"), at)
    got = {(r.name, r.line_no): r.line for r in mg.read_ndjson(spark, at).collect()}
    assert got == {(str(b), n): f'{{"p":{n + 1}}}' for b in (1, 2) for n in range(3)}
