import uuid

import pytest

from pyspark.sql import functions as F

from orrery.operators.features import prepare_ingest
from orrery.operators.incremental import process_incremental
from orrery.session import ensure_checkpoint_dir, stage_path
from orrery.sources.observations import observations
from orrery.sources.tables import CommitConflict, Tables, sample_processed
from orrery.streaming.incremental import read_sink, run_incremental
from tests.conftest import SF_SMALL


def test_refresh_twice_equals_once_and_append_doubles(spark):
    t = Tables(spark, stage_path(spark, "t"))
    src = prepare_ingest(observations(spark, SF_SMALL))
    n1 = t.replace(src, "obs")
    n2 = t.replace(src, "obs")
    assert n1 == n2 == t.read("obs").count()
    assert t.load(src, "obs", "append") == n1 and t.read("obs").count() == 2 * n1
    run = t.log_run("INGESTION", "COMPLETED", n1, {"rows": n1}, run_id="INGEST_X")
    assert t.read("pipeline_runs").where(F.col("run_id") == run).count() == 1


def test_incremental_second_pass_processes_nothing(spark):
    table, n = process_incremental(observations(spark, SF_SMALL), now="2024-01-01 00:00:00")
    again, n2 = process_incremental(table, now="2024-01-01 00:00:00")
    assert n > 0
    assert n2 == table.where(~F.col("is_processed")).count()      # only NULL-target rows remain
    # the update never touches a NULL-target row (they stay unprocessed)
    assert again.where(F.col("class").isNull() & F.col("updated_at").isNotNull()).count() == 0


def test_stream_equals_batch(spark):
    base = f"{ensure_checkpoint_dir(spark)}/t-{uuid.uuid4().hex[:6]}"
    src = observations(spark, SF_SMALL).where(~F.col("is_processed"))
    src.write.parquet(f"{base}/src")
    args = dict(spark=spark, source=f"{base}/src", schema=src.schema, sink=f"{base}/sink",
                checkpoint=f"{base}/ck", now="2024-01-01 00:00:00")
    assert run_incremental(**args) == src.count()
    assert run_incremental(**args) == 0
    streamed = read_sink(spark, f"{base}/sink").where("is_processed").select("obj_id", "u_g_color").toPandas()
    batch, _ = process_incremental(src, now="2024-01-01 00:00:00")
    b = batch.where("is_processed").select("obj_id", "u_g_color").toPandas()
    m = streamed.merge(b, on="obj_id")
    assert len(m) == len(b) == len(streamed) and (m.u_g_color_x == m.u_g_color_y).all()


def test_tables_hold_across_objects(spark):
    root = stage_path(spark, "t")
    a = spark.range(10).withColumn("p", F.col("id") % 2)
    assert Tables(spark, root).load(a, "t1", "append") == 10
    assert Tables(spark, root).load(a, "t1", "append") == 10
    assert spark.table("t1").count() == Tables(spark, root).read("t1").count() == 20
    with pytest.raises(ValueError):
        Tables(spark, root).load(a, "t1", "fail")
    assert Tables(spark, root).load(a.limit(3), "t1", "replace", ["p"]) == 3
    assert Tables(spark, root).load(a.limit(3), "t1", "append", ["p"]) == 3
    assert sorted(r.id for r in spark.table("t1").collect()) == [0, 0, 1, 1, 2, 2]
    assert Tables(spark, root).vacuum("t1") == 1 and spark.table("t1").count() == 6


def _while_writing(monkeypatch, table, other):
    """The next part that ``table`` writes is finished only after ``other`` has run."""
    write = table._write_part

    def slow(*args):
        part = write(*args)
        monkeypatch.setattr(table, "_write_part", write)
        other()
        return part

    monkeypatch.setattr(table, "_write_part", slow)


def test_an_append_beside_a_replacement_is_kept(spark, monkeypatch):
    root = stage_path(spark, "t")
    a, b = Tables(spark, root), Tables(spark, root)
    a.load(spark.range(3), "t2")
    _while_writing(monkeypatch, a, lambda: b.replace(spark.range(100, 105), "t2"))
    assert a.load(spark.range(10, 12), "t2") == 2
    assert sorted(r.id for r in b.read("t2").collect()) == [10, 11, 100, 101, 102, 103, 104]
    assert b.read("t2", 0).count() == 3 and b.read("t2", 1).count() == 5
    assert [tuple(r)[:5] for r in b.history("t2").orderBy("version").collect()] == [
        (0, "create", None, 1, 3), (1, "replace", 0, 1, 5), (2, "append", 0, 2, 7)]
    with pytest.raises(ValueError):
        a.read("t2", 9)
    assert a.vacuum("t2") == 1 and a.versions("t2") == [1, 2] and a.read("t2").count() == 7


def test_a_replacement_beside_an_append_is_refused(spark, monkeypatch):
    root = stage_path(spark, "t")
    a, b = Tables(spark, root), Tables(spark, root)
    a.load(spark.range(3), "t3")
    _while_writing(monkeypatch, a, lambda: b.load(spark.range(10, 12), "t3"))
    with pytest.raises(CommitConflict):
        a.replace(spark.range(1), "t3")
    assert b.read("t3").count() == 5
    assert a.replace(spark.range(1), "t3") == 1 and b.read("t3").count() == 1  # having seen it
    _while_writing(monkeypatch, a, lambda: b.load(spark.range(2), "t4", "fail"))
    with pytest.raises(CommitConflict):
        a.load(spark.range(1), "t4", "fail")
    assert b.read("t4").count() == 2


def test_a_number_is_committed_once(spark):
    t = Tables(spark, stage_path(spark, "t"))
    t.load(spark.range(1), "t5")
    entry = {"version": 1, "operation": "append", "seen": 0, "parts": [], "committed_at": ""}
    assert t._put("t5", entry) and not t._put("t5", {**entry, "parts": [1]})
    assert t.commit("t5", 1)["parts"] == [] and t.versions("t5") == [0, 1]


def test_many_writers_lose_no_part(spark):
    from concurrent.futures import ThreadPoolExecutor
    root = stage_path(spark, "t")
    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda k: Tables(spark, root).load(spark.range(k, k + 1), "t6"), range(6)))
    assert sorted(r.id for r in Tables(spark, root).read("t6").collect()) == list(range(6))


def test_failed_ingest_is_logged_and_raised(spark):
    t = Tables(spark, stage_path(spark, "t"))
    assert t.ingest(spark.range(5), "x", lambda df: df) == 5
    with pytest.raises(Exception, match="nope"):
        t.ingest(spark.range(7), "x", lambda df: df.select("nope"))
    log = {r.status: r for r in t.read("pipeline_runs").collect()}
    assert log["COMPLETED"].records_processed == 5 and "nope" in log["FAILED"].error_message
    assert t.read("x").count() == 5


def test_stream_keeps_every_row_and_the_last_of_each_key(spark):
    base = stage_path(spark, "s")
    schema = "obj_id string, u double, g double, r double, i double, z double, class string, is_processed boolean"
    row = lambda k, g, c, p=False: (k, 5.0, g, 1.0, 1.0, 1.0, c, p)
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{base}/src")
    args = dict(spark=spark, source=f"{base}/src", schema=schema, sink=f"{base}/sink", checkpoint=f"{base}/ck",
                now="2024-01-01 00:00:00", max_files=1)
    put([row("a", 1.0, "x"), row("b", None, "x"), row("p", 1.0, "x", True)])
    put([row("q", 2.0, "x", True), row("c", 3.0, None), row("d", None, "y")])
    assert run_incremental(**args) == 6 and run_incremental(**args) == 0
    put([row("a", 9.0, "x"), row("e", None, "x")])
    assert run_incremental(**args) == 2
    got = {r.obj_id: (r.is_processed, r.u_g_color) for r in read_sink(spark, f"{base}/sink").collect()}
    from orrery.streaming.incremental import compact, vacuum
    whole = read_sink(spark, f"{base}/sink")
    files = sorted(whole.inputFiles())
    assert compact(spark, f"{base}/sink", buckets=4) == 2 and compact(spark, f"{base}/sink") is None
    packed = read_sink(spark, f"{base}/sink")
    assert packed.exceptAll(whole).count() == whole.exceptAll(packed).count() == 0 and packed.columns == whole.columns
    assert all("/_base/2/" in f for f in packed.inputFiles()) and len(packed.inputFiles()) <= 4
    assert "Window" not in packed._jdf.queryExecution().toString() and files
    put([row("a", 7.0, "x"), row(None, 1.0, "x"), row("z", 1.0, "x")])
    put([row("a", 8.0, "x"), row(None, 2.0, "x")])
    assert run_incremental(**args, compact_after=9) == 5
    later = {(r.obj_id, r.g): r.u_g_color for r in read_sink(spark, f"{base}/sink").collect() if r.obj_id in (None, "a", "z")}
    assert later == {("a", 8.0): -3.0, (None, 1.0): 4.0, (None, 2.0): 3.0, ("z", 1.0): 4.0}
    before = read_sink(spark, f"{base}/sink").collect()
    assert run_incremental(**args, compact_after=2) == 0 and vacuum(spark, f"{base}/sink") == 6
    after = read_sink(spark, f"{base}/sink")
    assert all("/_base/4/" in f for f in after.inputFiles()) and sorted(map(str, after.collect())) == sorted(map(str, before))
    # the median of g over the unprocessed rows of the first run is 2
    assert got == {"a": (True, -4.0), "b": (True, 3.0), "p": (True, None), "q": (True, None), "c": (False, None),
                   "d": (True, 3.0), "e": (True, 3.0)}


def test_sample_has_no_silent_clamp(spark):
    df = spark.range(300).select(F.col("id").alias("obj_id"), F.lit(True).alias("is_processed"))
    assert sample_processed(df, 250).count() == 250
    for bad in (0, 101):
        with pytest.raises(ValueError):
            sample_processed(df, bad, max_limit=100)


def test_csv_quarantine(spark, tmp_path):
    from orrery.sources.scan import read_csv_typed
    p = tmp_path / "in.csv"
    p.write_text("a,b\n1.5,x\nNaN,y\nnot-a-number,z\n,w\n")
    good, bad = read_csv_typed(spark, str(p), "a double, b string")
    g = sorted(((r["a"], r["b"]) for r in good.collect()), key=lambda t: t[1])
    assert g == [(None, "w"), (1.5, "x"), (None, "y")]
    assert [r["_corrupt_record"] for r in bad.collect()] == ["not-a-number,z"]


def test_stream_scoring_equals_batch(spark):
    from orrery.operators.score import score
    from orrery.operators.forest import train_random_forest
    from orrery.plans.catalog import FEATURES, labelled_split
    from orrery.sources.observations import CLASS_LABELS
    from orrery.streaming.scoring import score_stream
    df = labelled_split(spark, SF_SMALL)
    m = train_random_forest(df.where("data_split='TRAIN'"), FEATURES, num_trees=10, max_depth=5)
    base = f"{ensure_checkpoint_dir(spark)}/s-{uuid.uuid4().hex[:6]}"
    rows = df.withColumnRenamed("label", "class").drop("u_g", "g_r", "r_i", "i_z")
    rows.write.parquet(f"{base}/src")
    score_stream(spark, f"{base}/src", rows.schema, m, FEATURES, CLASS_LABELS,
                 sink=f"{base}/out", checkpoint=f"{base}/ck")
    s = spark.read.parquet(f"{base}/out").select("obj_id", "predicted_class", "prediction_probability").toPandas()
    b = score(rows, m, FEATURES, CLASS_LABELS).select("obj_id", "predicted_class", "prediction_probability").toPandas()
    # obj_id repeats at sf0.001, so compare the two outputs as sorted multisets
    cols = ["obj_id", "predicted_class", "prediction_probability"]
    s = s.sort_values(cols).reset_index(drop=True)
    b = b.sort_values(cols).reset_index(drop=True)
    assert len(s) == len(b)
    assert (s.obj_id == b.obj_id).all() and (s.predicted_class == b.predicted_class).all()
    assert (s.prediction_probability - b.prediction_probability).abs().max() < 1e-12
