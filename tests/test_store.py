import pytest
from pyspark.sql import functions as F

from fleetspark.sources import star_load
from fleetspark.sources.scratch import folder
from fleetspark.sources.store import Store, bucket
from fleetspark.plans import fleet


def rows(spark, *values):
    return spark.createDataFrame([*values], "id long, day int, a string, b string, o int")


def state(df):
    return sorted(tuple(r) for r in df.collect())


def test_a_merge_touches_its_parts_only(spark):
    store = Store(spark, folder(spark, "store"))
    load = store.begin()
    assert load.read("t") is None and not load.commit()
    first = rows(spark, *[(i, 20240101 + i % 5, f"a{i}", f"b{i}", i) for i in range(50)])
    assert sorted(load.merge("t", first, ["id"], ["a"], F.col("day"), ["o"])) == [str(20240101 + d) for d in range(5)]
    assert load.commit() and len(store.versions()) == 1
    before = {f.rpartition("/")[0]: f for f in store.read("t").inputFiles()}

    load = store.begin()
    batch = rows(spark, (3, 20240104, "new", "new", 1), (3, 20240104, "newer", "new", 2), (77, 20240104, "x", "y", 1))
    assert load.merge("t", batch, ["id"], ["a"], F.col("day"), ["o"]) == ["20240104"]
    read_again = load.read("t", ["20240104"])
    assert state(store.read("t")) == state(first.drop("o"))  # readers see the version before until the load commits
    load.commit()
    after = {f.rpartition("/")[0]: f for f in store.read("t").inputFiles()}
    assert len(set(before) & set(after)) == 4 and all(before[k] == after[k] for k in set(before) & set(after))
    assert read_again.count() == 11
    want = {i: (i, 20240101 + i % 5, f"a{i}", f"b{i}") for i in range(50)} | {3: (3, 20240104, "newer", "b3"), 77: (77, 20240104, "x", "y")}
    assert state(store.read("t")) == sorted(want.values())
    assert state(store.begin(version=0).read("t")) == state(first.drop("o"))


def test_the_plan_of_a_merge_reads_no_other_part(spark):
    store = Store(spark, folder(spark, "store"))
    load = store.begin()
    load.merge("t", rows(spark, *[(i, 20240101 + i % 5, "a", "b", 0) for i in range(50)]), ["id"], ["a"], F.col("day"), ["o"])
    old = load.read("t", ["20240103", "20991231"])
    assert all("_part=20240103" in f for f in old.inputFiles()) and old.count() == 10
    assert load.read("t", ["20991231"]) is None


def test_a_merge_again_changes_nothing_and_nulls_have_a_part(spark):
    store, batch = Store(spark, folder(spark, "store")), rows(spark, (1, None, "a", "b", 1), (2, 20240101, "c", None, 1))
    for _ in range(2):
        load = store.begin()
        load.merge("t", batch, ["id"], ["a", "b"], F.col("day"), ["o"])
        load.merge("u", batch, ["id"], ["a"], bucket("id", of=3), ["o"])
        load.commit()
    assert [sorted(map(str, r)) for r in store.read("t").orderBy("id").collect()] == [sorted(map(str, r)) for r in batch.drop("o").orderBy("id").collect()]
    assert store.read("u").count() == 2 and len(store.versions()) == 2
    load = store.begin()
    assert load.merge("t", batch.where("false"), ["id"], ["a"], F.col("day"), ["o"]) == [] and not load.commit()


def test_a_load_that_stops_leaves_nothing(spark, sf_dir, monkeypatch):
    store, raw = Store(spark, folder(spark, "star")), folder(spark, "landing")
    sources = {k: v for k, v in fleet._landings(spark, sf_dir).items() if k in ("foundry_traces", "purview_audit")}
    fleet._land(spark, sources, raw, 1)
    with monkeypatch.context() as m:
        m.setattr(star_load, "audit_rows", lambda rows: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            star_load.load_star(spark, store, raw, buckets=2)
    assert store.versions() == [] and store.read("etl_load_log") is None
    assert star_load.load_star(spark, store, raw, buckets=2)
    assert not star_load.load_star(spark, store, raw, buckets=2) and len(store.versions()) == 1


def test_a_rebuild_keeps_the_curated_bridge_and_switches_at_once(spark, sf_dir):
    store, raw = Store(spark, folder(spark, "star")), folder(spark, "landing")
    sources = {k: v for k, v in fleet._landings(spark, sf_dir).items() if k == "foundry_traces"}
    for landing_ in (1, 2):
        fleet._land(spark, sources, raw, landing_)
    star_load.load_star(spark, store, raw, fleet._catalogue(spark, sf_dir, False), buckets=2)
    curate = store.begin()
    curate.put("bridge_agent_identity", spark.createDataFrame([("foundry_otel", "bridge4", 4, None)], "id_namespace string, native_id string, agent_key long, valid_to string"))
    curate.commit()
    keys = {r["native_agent_id"]: r["agent_key"] for r in store.read("dim_agent").collect()}
    assert store.read("fact_agent_traces").where("resolution_tier = 'bridge'").isEmpty()
    load = store.read("fact_agent_traces")
    assert star_load.load_star(spark, store, raw, fleet._catalogue(spark, sf_dir, False), rebuild=True, buckets=2)
    again = store.read("fact_agent_traces")
    assert again.count() == load.count() and not again.where("resolution_tier = 'bridge' AND agent_key = 4").isEmpty()
    assert store.read("bridge_agent_identity").count() == 1 and store.read("etl_load_log").agg(F.sum("row_count")).first()[0] == sources["foundry_traces"].count()
    assert {r["native_agent_id"]: r["agent_key"] for r in store.read("dim_agent").collect()}.keys() == keys.keys()


SPAN = "trace_id string, span_id string, gen_ai_agent_id string, timestamp string"


def test_the_first_id_of_a_trace_by_row_and_from_run_to_run(spark):
    """The first id is that of the first row, whatever the span's id; with state, of the first run that saw the trace."""
    for carry, want in ((False, {"a": "correlation", "z": "bridge", "late": "unattributed"}), (True, {"a": "correlation", "z": "bridge", "late": "correlation"})):
        store, raw = Store(spark, folder(spark, "star")), folder(spark, "landing")
        curate = store.begin()
        curate.put("bridge_agent_identity", spark.createDataFrame([("foundry_otel", "x", 42, None)], "id_namespace string, native_id string, agent_key long, valid_to string"))
        curate.commit()
        for n, spans in ((1, [("t", "z", "x:1", "2024-01-01T00:00:00Z"), ("t", "a", "other", "2024-01-01T00:00:01Z"), ("t", "m", None, None)]), (2, [("t", "late", None, "2024-01-01T00:00:02Z"), (None, "n", None, "2024-01-01T00:00:03Z")])):
            schema = star_load.landed("foundry_traces")
            have = spark.createDataFrame(spans, SPAN).coalesce(1)
            have.select(*[(F.col(f.name) if f.name in have.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema]).write.parquet(f"{raw}/foundry/traces/dt=2024-01-0{n}")
            star_load.load_star(spark, store, raw, carry_traces=carry, buckets=2)
        assert {r["span_id"]: r["resolution_tier"] for r in store.read("fact_agent_traces").collect()} == want


def test_a_catalogue_is_parsed_once(spark):
    """A load reads its catalogue's agents many times; they are stored, so that no later plan parses the pages again."""
    pages = [('{"value":[{"id":"a","displayName":"A","ownerId":"o"},{"id":"b","displayName":"A","ownerId":"00000000-0000-0000-0000-000000000000"}]}', "f", 3)]
    listed = star_load.registered(spark.createDataFrame(pages, "raw string, _file string, _row long"))
    assert [(r["native_agent_id"], r["cloud"], r["_row"]) for r in listed.collect()] == [("a", "m365", 3 << 32)]
    assert "parse" not in listed._jdf.queryExecution().optimizedPlan().toString().lower()
