"""Plan-shape checks: pruning and pushdown reach the scan; the split path and ids behave at small scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from riskframe.config import RiskConfig
from riskframe.operators import audit as au
from riskframe.operators import features as fe
from riskframe.plans.inspect import exchanges, plan_text, scan_summary
from riskframe.sources import contract
from riskframe.sources.fixtures import events_transactions, lineitem_transactions
from riskframe.streaming import ingest

SF = "/root/testdata/sf0.01"


def test_early_window_pushes_filter_to_scan(spark):
    scans = scan_summary(E.queries()["early_window"](spark, SF))
    assert any("LessThan(event_id,2500)" in s["pushed_filters"] for s in scans)


def test_lineitem_fixture_prunes_columns(spark):
    scans = scan_summary(E.queries()["q3_amount_bands"](spark, SF))
    cols = sorted(c for s in scans for c in s["read_columns"])
    assert "l_quantity" not in cols and "l_tax" not in cols and "o_totalprice" not in cols


def test_hot_and_cold_paths_agree(spark, txns):
    cold = fe.build_features(txns).select("txn_id", "dest_prior_txn_count", "dest_txn_prev_24h",
                                          "dest_prior_unique_senders", "type_prior_avg_amount")
    hot = fe.build_features(txns, RiskConfig(hot_key_rows=10, history_block=32)).select(
        "txn_id", "dest_prior_txn_count", "dest_txn_prev_24h", "dest_prior_unique_senders", "type_prior_avg_amount")
    assert cold.exceptAll(hot).count() == 0 and hot.exceptAll(cold).count() == 0


@pytest.mark.parametrize("fixture", [events_transactions, lineitem_transactions])
def test_chunk_rows_stay_below_steps_plus_rows_over_block(spark, fixture):
    """L1 of the hot-key plan, also where ids do not follow steps."""
    for block in (16, 256):
        src = fixture(spark, SF).select("txn_id", "step", "amount", F.struct("txn_type").alias("_key"))
        l1 = fe.chunk_table(src, fe._blocked(src, RiskConfig(history_block=block)))
        per = {r["_key"]: r["n"] for r in l1.groupBy("_key").agg(F.count("*").alias("n")).collect()}
        rows = {r["_key"]: (r["s"], r["n"]) for r in src.groupBy("_key").agg(
            F.countDistinct("step").alias("s"), F.count("*").alias("n")).collect()}
        assert per and all(per[k] <= s + n / block for k, (s, n) in rows.items())


def test_null_keys_are_split_like_any_other(spark):
    data = [(i, 1 + i // 7, "PAYMENT", float(i % 13), None if i % 3 else "C1", "D") for i in range(400)]
    df = spark.createDataFrame(data, "txn_id long, step int, txn_type string, amount double, name_orig string, name_dest string") \
              .withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    opts = dict(want_max=True, want_prev=True, prev_type=True, ranges={"v": (3, 1, "count"), "a": (3, 1, "sum")})
    plain = fe.past_only(df, ["name_orig"], **opts)
    split = fe.past_only(df, ["name_orig"], RiskConfig(hot_key_rows=50, history_block=4), **opts)
    forced = fe.past_only(df, ["name_orig"], RiskConfig(history_block=4), split_all=True, **opts)
    want = sorted(plain.collect())
    assert sorted(split.collect()) == want and sorted(forced.collect()) == want
    # the hot keys (the null one too) leave the plain branch
    hot = df.groupBy("name_orig").count().where("count > 50").collect()
    assert len(hot) == 2


def test_feature_chain_deals_full_rows_three_times(spark):
    """By origin (shared by pairs), by destination and by (type, step); the others carry one row per type and step."""
    df = fe.build_features(events_transactions(spark, "/root/testdata/sf0.001"))  # another test caches the sf0.01 plan
    by = exchanges(df)
    assert sum("name_orig" in x for x in by) == 1 and sum("name_dest" in x for x in by) == 1
    assert len(by) <= 6
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1  # the type prefix alone is joined


def _dealt_columns(df):
    """The widths of a plan's exchanges, in columns."""
    text = df.sparkSession.sparkContext._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    return [int(n) for n in re.findall(r"\) Exchange\nInput \[(\d+)\]", text)]


def test_feature_chain_deals_statistics_not_features(spark):
    """No exchange of the plain plan carries the finished features, some forty columns."""
    widths = _dealt_columns(fe.build_features(events_transactions(spark, "/root/testdata/sf0.001").where("txn_id >= 0")))
    assert widths and max(widths) < 30, widths


def test_rows_without_a_step_count_for_accounts(spark):
    data = [(1, None, "DEBIT", 5.0, "C1", "D1", 0), (2, 3, "DEBIT", 7.0, "C1", "D1", 0), (3, 4, "DEBIT", 9.0, "C1", "D1", 1)]
    df = spark.createDataFrame(data, "txn_id long, step int, txn_type string, amount double, name_orig string, name_dest string, "
                                     "is_fraud int").withColumn("amount", F.col("amount").cast("decimal(18,2)"))
    got = fe.build_features(df).select("txn_id", "orig_prior_txn_count", "dest_prior_txn_count", "pair_prior_txn_count").collect()
    assert sorted(tuple(r) for r in got) == [(2, 1, 1, 1), (3, 2, 2, 2)]


def test_lineitem_fixture_deals_lines_once(spark):
    by = exchanges(lineitem_transactions(spark, SF))
    assert sum("l_orderkey" in x for x in by) == 1 and not any("l_linenumber" in x for x in by)


def test_feature_chain_with_hot_keys_keeps_one_branch(spark):
    """Rows are dealt once a family, hot keys or not; every family's windows stand once in the plan."""
    txns = events_transactions(spark, "/root/testdata/sf0.001")
    df = fe.build_features(txns, RiskConfig(hot_key_rows=3))
    assert len(exchanges(df)) <= 8
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan
    windows = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Window")]
    cold = fe.build_features(txns)._jdf.queryExecution().optimizedPlan().toString()
    assert len(windows) <= 1 + sum(line.lstrip(" :+-").startswith("Window") for line in cold.splitlines())
    assert sum("is_first_contact" in line for line in windows) == 1  # the sum over it; found by one pair window


def test_large_groups_are_cut_evenly_whatever_their_ids(spark):
    """Ids in two far clusters and one far outlier: no range holds more than twice history_block rows."""
    ids = [*range(1000, 9000), *range(10 ** 12, 10 ** 12 + 9000), 2 ** 62]
    df = spark.createDataFrame([(i, 5, "C1") for i in ids] + [(i, 6, "C1") for i in range(500)], "txn_id long, step int, name_orig string")
    src = df.select("txn_id", "step", F.struct("name_orig").alias("_key"))
    block = 512
    out = fe._blocked(src, RiskConfig(history_block=block))(src)
    ranges = out.groupBy("step", "_blk").agg(F.count("*").alias("n"), F.min("txn_id").alias("lo"), F.max("txn_id").alias("hi")).collect()
    big = sorted((r for r in ranges if r["step"] == 5), key=lambda r: r["_blk"])
    assert len(big) > 20 and all(r["n"] <= 2 * block for r in big) and sum(r["n"] for r in big) == len(ids)
    assert all(a["hi"] < b["lo"] for a, b in zip(big, big[1:]))
    assert [r["_blk"] for r in ranges if r["step"] == 6] == [0]


def test_edges_of_large_groups_stay_few_however_small_a_block_is(spark, monkeypatch):
    """A block far too small for the rows: edges are still broadcast, so finding a row's range deals no rows."""
    monkeypatch.setattr("riskframe.session._SMALL_TABLE", 64)
    monkeypatch.setattr(fe, "_MOST_EDGES", 32, raising=False)
    df = spark.createDataFrame([(i * i, 5 + i % 2, "C1", 1) for i in range(6000)], "txn_id long, step int, name_orig string, a int")
    src = df.select("txn_id", "step", F.struct("name_orig").alias("_key"))
    out = fe._blocked(src, RiskConfig(history_block=4))(src)
    assert exchanges(out) == []
    sizes = [r["count"] for r in out.groupBy("step", "_blk").count().collect()]
    assert len(sizes) > 16 and sum(sizes) == 6000 and max(sizes) <= 2 * 6000 / 32


def test_duplicates_shuffle_no_key_columns_of_unique_rows(spark):
    txns = events_transactions(spark, "/root/testdata/sf0.001")
    both = txns.unionByName(txns.where("txn_id % 10 = 0")).unionByName(txns.where("txn_id % 10 = 0").limit(1))
    assert tuple(au.duplicate_rows(both).first()) == (100, 101)
    nulls = spark.createDataFrame([(1, None, "a"), (1, "a", None), (1, None, "a"), (None, None, None), (None, None, None)], "x int, y string, z string")
    assert tuple(au.duplicate_rows(nulls, ["x", "y", "z"]).first()) == (2, 2)
    plan = plan_text(au.duplicate_rows(both))
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_one_family_queries_build_no_other_family(spark):
    for name, other in (("orig_gap", "name_dest"), ("velocity", "name_orig"), ("dest_gap", "name_orig"), ("type_baseline", "name_dest")):
        plan = E.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        windows = [line for line in plan.splitlines() if line.lstrip(" :+-").startswith("Window")]
        assert windows and not any(other in line for line in windows), name


def test_sequential_ids_are_dense_in_file_order(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    got = contract.sequential_ids(ev).select("event_id", "txn_id")
    r = got.agg(F.count("*"), F.countDistinct("txn_id"), F.min("txn_id"), F.max("txn_id"),
                F.sum(F.when(F.col("txn_id") != F.col("event_id") + 1, 1).otherwise(0))).first()
    assert r[0] == r[1] == r[3] and r[2] == 1 and r[4] == 0


def test_sequential_ids_follow_files_and_splits(spark, tmp_path):
    """Many files of many splits each: ids run in the order of file name and line."""
    session = spark.newSession()
    session.conf.set("spark.sql.files.maxPartitionBytes", "2k")
    at = 0
    for i, n in enumerate((900, 20, 1500, 1)):
        (tmp_path / f"part-{i}.csv").write_text("x\n" + "".join(f"{at + k}\n" for k in range(n)))
        at += n
    df = session.read.option("header", True).schema("x long").csv(str(tmp_path))
    assert df.rdd.getNumPartitions() > 5
    got = contract.sequential_ids(df)
    assert got.count() == at and got.where("txn_id <> x + 1").count() == 0


def _read_by_scans(df):
    """Rows that the scans of a collected plan have put out."""
    def walk(node):
        if "Scan text" in node.nodeName() or node.nodeName().startswith("Scan "):
            metric = node.metrics().get("numOutputRows")
            yield metric.get().value() if metric.isDefined() else 0
        inner = [node.children().apply(i) for i in range(node.children().size())]
        if node.nodeName() == "AdaptiveSparkPlan":
            inner = [node.executedPlan()]
        elif "QueryStage" in node.nodeName():
            inner = [node.plan()]
        for child in inner:
            yield from walk(child)
    return sum(walk(df._jdf.queryExecution().executedPlan()))


def test_headers_are_found_without_reading_the_data(spark, tmp_path, monkeypatch):
    header, row = ",".join(contract.RAW_COLUMNS), "1,TRANSFER,1.00,C1,0.1,0.2,C2,,9.99,1,0\n"
    for name, first in (("a", header), ("b", ",".join(reversed(contract.RAW_COLUMNS))), ("c", "step,amount"), ("d d", header)):
        (tmp_path / f"{name}.csv").write_text(first + "\n" + row * 120_000)
    (tmp_path / "e.csv").write_text("")
    lines = contract.first_lines(spark, [f"{tmp_path}/{n}.csv" for n in "abce"])
    found = {r["file"].rsplit("/", 1)[1]: r["value"] for r in lines.collect()}
    assert sorted(found) == ["a.csv", "b.csv", "c.csv"] and found["a.csv"] == header
    assert 3 <= _read_by_scans(lines) < 100
    monkeypatch.setattr(contract, "_FILES_A_JOB", 2)
    by = contract.files_by_header(spark, str(tmp_path))
    assert sorted(len(f) for f in by.values()) == [1, 2]


def test_scan_contract_skips_nonconforming_files(spark):
    df = E.queries()["scan_contract"](spark, "/root/testdata/sf0.001")
    assert df.count() == 1000 and df.columns[0] == "step" and len(df.columns) == 11


def test_money_is_exact_to_sixteen_digits(spark, tmp_path):
    (tmp_path / "a.csv").write_text(",".join(contract.RAW_COLUMNS) + "\n1,TRANSFER,1234567890123456.78,C1,0.1,0.2,C2,,9.99,1,0\n")
    row = contract.load_csv(spark, str(tmp_path)).first()
    assert str(row.amount) == "1234567890123456.78" and row.old_balance_dest is None and row.txn_id == 1
    (tmp_path / "b.csv").write_text("step,amount\n1,2\n")
    assert contract.load_csv(spark, str(tmp_path)).count() == 1
    with pytest.raises(contract.ContractError):
        contract.load_csv(spark, str(tmp_path / "b.csv"))


def test_stream_refuses_a_reordered_header(spark, tmp_path):
    raw = contract.raw_from_canonical(events_transactions(spark, "/root/testdata/sf0.001"))
    raw.select(*reversed(raw.columns)).write.option("header", True).csv(f"{tmp_path}/raw")
    with pytest.raises(Exception, match="(?i)header"):
        ingest.ingest(spark, f"{tmp_path}/raw", f"{tmp_path}/sink", f"{tmp_path}/ckpt").awaitTermination()


def _raw_files(spark, path, files=4):
    raw = contract.raw_from_canonical(events_transactions(spark, "/root/testdata/sf0.001"))
    raw.repartition(files).write.option("header", True).csv(path)


def _ids(df):
    return tuple(df.agg(F.count("*"), F.countDistinct("txn_id"), F.min("txn_id"), F.max("txn_id")).first())


def test_stream_restart_writes_each_file_once(spark, tmp_path):
    raw = contract.raw_from_canonical(events_transactions(spark, "/root/testdata/sf0.001"))
    args = (spark, f"{tmp_path}/raw", f"{tmp_path}/sink")
    for part in (raw.where("step <= 200"), raw.where("step > 200")):
        part.write.mode("append").option("header", True).csv(args[1])
        for _ in range(2):
            ingest.ingest(*args).awaitTermination()
    assert _ids(ingest.ingested(spark, args[2])) == (1000, 1000, 1, 1000)


def test_a_second_writer_and_a_lost_checkpoint_are_refused(spark, tmp_path):
    _raw_files(spark, f"{tmp_path}/raw")
    args = (spark, f"{tmp_path}/raw", f"{tmp_path}/sink")
    ingest.ingest(*args, checkpoint=f"{tmp_path}/one").awaitTermination()
    with pytest.raises(ValueError, match="is written from"):
        ingest.ingest(*args, checkpoint=f"{tmp_path}/two")
    (tmp_path / "one").rename(tmp_path / "gone")
    with pytest.raises(ValueError, match="does not exist"):
        ingest.ingest(*args, checkpoint=f"{tmp_path}/one")
    assert _ids(ingest.ingested(spark, args[2])) == (1000, 1000, 1, 1000)


@pytest.mark.parametrize("late", [False, True])
def test_a_batch_killed_between_write_and_commit_is_not_seen(spark, tmp_path, monkeypatch, late):
    """The attempt is complete and no manifest names it, or (late) the manifest is there and the query has not noted it."""
    _raw_files(spark, f"{tmp_path}/raw")
    args = (spark, f"{tmp_path}/raw", f"{tmp_path}/sink", f"{tmp_path}/ckpt")
    commit, calls = ingest._commit, []

    def killed(*a):
        calls.append(a[2])
        if len(calls) == 2:
            if late:
                commit(*a)
            raise RuntimeError("killed")
        commit(*a)

    with monkeypatch.context() as m:
        m.setattr(ingest, "_commit", killed)
        with pytest.raises(Exception, match="killed"):
            ingest.ingest(*args, max_files_per_trigger=1).awaitTermination()
    seen = ingest.ingested(spark, args[2])
    assert len(list((tmp_path / "sink" / "batches").glob("*/attempt=*/_SUCCESS"))) == 2
    assert [r["batch_id"] for r in seen.select("batch_id").distinct().orderBy("batch_id").collect()] == ([0, 1] if late else [0])
    ingest.ingest(*args, max_files_per_trigger=1).awaitTermination()
    out = ingest.ingested(spark, args[2])
    assert _ids(out) == (1000, 1000, 1, 1000) and out.select("batch_id").distinct().count() == 4
    assert len(list((tmp_path / "sink" / "batches").glob("*/attempt=*"))) == (4 if late else 5)


def test_a_sink_without_a_batch_has_no_rows(spark, tmp_path):
    assert ingest.ingested(spark, f"{tmp_path}/none").count() == 0


def test_stream_ingest_appends_every_row_once(spark):
    df = E.queries()["stream_ingest"](spark, "/root/testdata/sf0.001")
    assert df.count() == 1000


def test_stream_ingest_many_batches_unique_ids(spark, tmp_path):
    base = str(tmp_path)
    _raw_files(spark, f"{base}/raw")
    ingest.ingest(spark, f"{base}/raw", f"{base}/sink", f"{base}/ckpt", max_files_per_trigger=1).awaitTermination()
    out = ingest.ingested(spark, f"{base}/sink")
    assert _ids(out) == (1000, 1000, 1, 1000) and out.select("batch_id").distinct().count() == 4
