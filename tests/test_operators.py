from datetime import date, datetime

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarazu.operators import dedupe, matching, parties, quality, ranking, statefold, upsert
from tarazu.plans import docindex, linkage
from tarazu.session import spread


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def test_dedupe(spark):
    df = spark.createDataFrame([(1, "b", None), (1, "a", ""), (1, "c", "u"), (None, "x", None), (None, "y", None)], "k int, v string, url string")
    assert rows(dedupe.first_wins(df, ["k"], [F.col("v")])) == [(None, "x", None), (1, "a", "")]
    assert rows(dedupe.last_wins(df, ["k"], [F.col("v")])) == [(None, "y", None), (1, "c", "u")]
    assert rows(dedupe.most_complete(df, ["k"], ["url"], [F.col("v")])) == [(None, "x", None), (1, "c", "u")]
    assert dedupe.first_wins(df.limit(0), ["k"], [F.col("v")]).count() == 0


def test_upsert_is_idempotent_and_keeps_values(spark):
    old = spark.createDataFrame([(1, "a", "x"), (2, "b", None), (None, "n", None)], "k int, v string, w string")
    new = spark.createDataFrame([(2, None, "y"), (3, "c", None), (None, "m", None)], "k int, v string, w string")
    once = upsert.upsert(old, new, ["k"])
    assert rows(once) == [(None, "m", None), (1, "a", "x"), (2, "b", "y"), (3, "c", None)]
    assert rows(upsert.upsert(once, new, ["k"])) == rows(once)
    assert rows(upsert.fill_nulls(old, new, ["k"], ["w"]))[2] == (2, "b", "y")
    assert {r.action for r in upsert.diff(old, new, ["k"], ["v"]).collect()} == {"insert", "update", "absent"}
    assert {r.fate for r in upsert.mirror(old, new.limit(0), ["k"]).collect()} == {"kept"}
    top = upsert.number_new(new.select("v").where("v is not null"), old.withColumnRenamed("k", "i"), "i", ["v"])
    assert rows(top, "i") == [("c", 3), ("m", 4)]


def test_pages(spark):
    for n, size in ((0, 5), (1, 5), (50, 50), (51, 50), (101, 50)):
        df = spark.createDataFrame([("g", i) for i in range(n)] + [("h", 1)], "g string, i int")
        got = ranking.pages(df, ["g"], ["i"], size).where("g = 'g'")
        assert got.select("page_no").distinct().count() == -(-n // size)
        assert all(r.next_page == (r.page_no + 1 if (r.page_no + 1) * size < n else None) and r.page_no == r.i // size for r in got.collect())


def test_pages_of_wide_and_skewed_frames(spark):
    n = 60_000
    df = spark.range(n).select(F.when(F.col("id") % 3 > 0, "hot").when(F.col("id") % 2 == 0, F.concat(F.lit("g"), (F.col("id") % 50).cast("string"))).alias("g"), F.pmod(F.xxhash64("id"), F.lit(n * 100)).alias("i"), "id", F.repeat(F.lit("x"), 50).alias("wide"))
    w = Window.partitionBy("g").orderBy("i", "id")
    want = df.select("id", F.floor((F.row_number().over(w) - 1) / 25).cast("int").alias("want"), F.count(F.lit(1)).over(Window.partitionBy("g")).alias("n"))
    got = ranking.pages(df, ["g"], ["i", "id"], 25).join(want, "id")
    nxt = F.when(F.col("want") < F.floor((F.col("n") - 1) / 25), F.col("want") + 1)
    assert got.count() == n and got.where((F.col("page_no") != F.col("want")) | ~F.col("next_page").eqNullSafe(nxt)).count() == 0
    assert ranking.pages(df.limit(0), ["g"], ["i"], 25).count() == 0


def test_windows(spark):
    df = spark.createDataFrame([("a", i) for i in (1, 2, 3, 7, 8, 10, 10)], "k string, n long")
    assert rows(ranking.islands(df, ["k"], "n")) == [("a", 1, 3, 3), ("a", 7, 8, 2), ("a", 10, 10, 1)]
    assert rows(ranking.to_delete(df, "n", 3), "n") == [(1,), (2,), (3,)]
    c = spark.createDataFrame([("a", 1, "x"), ("a", 2, None), ("a", 3, "y"), ("b", 1, None)], "k string, n int, v string")
    assert [r.c for r in ranking.carry_forward(c, ["k"], ["n"], "v", "c").orderBy("k", "n").collect()] == ["x", "x", "y", None]


def test_carry_forward_of_a_hot_key(spark):
    df = spark.range(4000).select(F.when(F.col("id") % 5 > 0, "hot").when(F.col("id") % 2 > 0, "cold").alias("k"), F.when(F.col("id") % 97 > 0, F.pmod(F.xxhash64("id"), F.lit(10**9))).alias("n"), "id", F.when(F.col("id") % 400 == 3, F.col("id")).alias("v"))
    w = Window.partitionBy("k").orderBy("n", "id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.select("id", F.last("v", ignorenulls=True).over(w).alias("want"))
    got = ranking.carry_forward(df, ["k"], ["n", "id"], "v", "c").join(want, "id")
    assert got.count() == 4000 and got.where(~F.col("c").eqNullSafe(F.col("want"))).count() == 0
    assert ranking.carry_forward(df.limit(0), ["k"], ["n"], "v", "c").count() == 0


def test_joins(spark):
    a = spark.createDataFrame([(1, "k", date(2024, 1, 1)), (2, "k", None), (3, None, date(2024, 1, 1))], "i int, k string, d date")
    b = spark.createDataFrame([(9, "k", date(2024, 1, 4)), (8, "k", date(2024, 1, 5)), (7, "k", date(2023, 12, 29))], "j int, k string, e date")
    assert rows(matching.band_join(a, b, ["k"], "d", "e", 3).select("i", "j")) == [(1, 7), (1, 9)]
    led = spark.createDataFrame([("u", date(2024, 1, 2))], "u string, d date")
    units = spark.createDataFrame([("u",), ("v",)], "u string")
    assert matching.missing_days(units, "u", led, "d", F.lit("2024-01-01").cast("date"), F.lit("2024-01-03").cast("date")).count() == 5
    first, second = spark.createDataFrame([("k", None)], "k string, value string"), spark.createDataFrame([("k", "s"), ("m", "t")], "k string, value string")
    asked = spark.createDataFrame([("k",), ("m",), ("z",)], "k string")
    assert rows(matching.two_level(asked, "k", first, second, "value").select("k", "value", "level"), "k") == [("k", None, 1), ("m", "t", 2), ("z", None, None)]
    picked = spark.createDataFrame([(i,) for i in (-1, 0, 1, 2, 3)], "i int").select(matching.pick_by_index(F.array(F.lit("a"), F.lit("b")), F.col("i")).alias("p"))
    assert [r.p for r in picked.collect()] == [None, None, "a", "b", None]


def test_parties(spark):
    df = spark.createDataFrame([(1, "c", " राम "), (2, "c", "राम"), (3, "c", "वादी"), (4, "c", "-"), (5, "c", None), (6, "c", "न" * 501), (7, "c", "प्रतिवादीको विवरण"), (8, "c", "न" * 501)], "id int, k string, name string")
    got = rows(parties.clean_parties(df, ["k"], "name", ["id"]), "id")
    assert [(g[0], len(g[2])) for g in got] == [(1, 3), (6, 500)]
    split = spark.createDataFrame([(1, "/ क / ख", "ठेगाना")], "id int, name string, address string")
    assert rows(parties.split_rows(split, "name", "/", ["address"]), "pos") == [(1, "क", "ठेगाना", 0), (1, "ख", None, 1)]


def test_quality_and_folds(spark):
    df = spark.createDataFrame([("a", i < 1) for i in range(30)] + [("b", True)] * 3 + [("c", None)] * 25, "k string, bad boolean")
    assert {r.k: r.verdict for r in quality.drift(df, ["k"], F.col("bad")).collect()} == {"a": "drift", "b": "skipped", "c": "ok"}
    ev = spark.createDataFrame([("x", 1, 3), ("x", 1, 3), ("x", 2, 3), ("y", 1, 1)], "k string, part int, total int")
    assert {r.k: r.complete for r in statefold.barrier(ev, ["k"], "part", "total").collect()} == {"x": False, "y": True}
    tries = spark.createDataFrame([("p", i, "f") for i in range(5)] + [("q", 1, "f"), ("q", 2, "s"), ("q", 3, "f"), ("r", 1, "s"), ("z", 1, "o")], "k string, n int, e string")
    got = statefold.retry_state(tries, "k", ["n"], "e", F.col("e") == "s", F.col("e") == "f", 5)
    assert rows(got, "k") == [("p", "failed", 5), ("q", "retrying", 1), ("r", "done", 0), ("z", "open", 0)]


def test_index(spark):
    files = spark.createDataFrame([("k", "b.docx"), ("k", "a.pdf"), ("k", "c.PDF"), ("k", "a.pdf")], "k string, name string")
    assert rows(docindex.documents_of_files(files, ["k"])) == [("k", ["a.pdf", "c.PDF", "b.docx"], 3)]
    docs = spark.createDataFrame([("r/a/x",), ("r/a/y",), ("r/b",)], "p string")
    assert {r.node: r.n_docs for r in docindex.tree_counts(docs, "p").collect()}["r/a"] == 2
    d = spark.createDataFrame([("p:1", "<T & Co>", "http://x", "s")], "document_id string, title string, url string, source string")
    page = docindex.page_files(d, "https://b").first()
    assert page.path == "d/p/1.html" and "<T & Co>" not in page.content and "\\u003cT \\u0026 Co\\u003e" in page.content
    local, remote = spark.createDataFrame([("a",)], "key string"), spark.createDataFrame([("a",), ("b",), ("up/c",)], "key string")
    assert {r.key: r.action for r in docindex.publish_plan(local, remote, "key", ["up/"]).collect()} == {"a": "upload", "b": "delete", "up/c": "keep"}


def test_linkage(spark):
    cases = spark.createDataFrame([("c1", "2080-05-10"), ("c2", None)], "case_key string, dated string")
    rel = spark.createDataFrame([(1, "2080-05-10", "x " * 60 + "राम लाल थापा", "t"), (2, "2080-05-13", "अरू", "t"), (3, "2080-05-14", "अरू", "t"), (4, "2080-05", "राम लाल थापा", "राम लाल थापा"), (5, None, "अरू", "t")], "press_id long, dated string, text string, title string")
    pairs = linkage.candidates(cases, rel)
    assert rows(pairs, "press_id") == [("c1", 1, 0), ("c1", 2, 3), ("c1", 4, 4)]
    names = spark.createDataFrame([("c1", "राम लाल थापा")], "case_key string, name string")
    scores = linkage.scored(pairs, names, rel)
    top = linkage.best(scores).first()
    assert (top.press_id, top.status, top.name) == (1, "matched", "राम लाल थापा") and top.score == pytest.approx(1.0)
    assert "राम लाल" in top.passage and scores.count() == 1  # release 4 is named by its title alone, which is too short
    assert scores.select(linkage.signals().alias("s")).first().s[:2] == ["defendant_name_similarity(1.00)", "matched_defendant:राम लाल थापा"]


def test_best_scored_is_the_best_of_all_pairs(spark):
    w = ["राम", "लाल", "थापा", "हरि", "कार्की", "सीता", "देवी", "गुरुङ"]
    said = [" ".join(w[(i * k + i) % 8] for k in range(1, 2 + i % 3)) for i in range(24)] + ["राम " * 30 + "थापा", "Ram Thapa", "क", "हरिराम प्रसाद"]
    cases = spark.createDataFrame([(f"c{i}", d) for i, d in enumerate(["2080-05-10", "2080-05-12", "2080-05", "2080-06-01", None, "x", "2081-01-01"])], "case_key string, dated string")
    names = spark.createDataFrame([(f"c{i % 8}", i, n) for i, n in enumerate(said)] + [("c0", 99, None), (None, 1, "राम लाल")], "case_key string, pos int, name string")
    days = ["2080-05-10", "2080-05-11", "2080-05-13", "2080-05", "2080-04-30", None, "junk", "2080"]
    texts = [" ".join(w[(i * 3 + k * k) % 8] for k in range(4 + 9 * (i % 4))) + (" " * 60 + "." if i % 7 == 0 else "") for i in range(40)] + ["", None]
    rel = spark.createDataFrame([(i, days[i % 8], t, None if i % 5 == 0 else "राम लाल थापा विरुद्ध मुद्दा") for i, t in enumerate(texts)] + [(None, "2080-05-10", texts[3], "t")], "press_id long, dated string, text string, title string")
    want = linkage.best(linkage.scored(linkage.all_candidates(cases, names, rel), names, rel), 3)
    got = linkage.best_scored(cases, names, rel, 3)
    assert rows(got, *sorted(got.columns)) == rows(want.drop("passage"), *sorted(got.columns)) and want.count() > 10
    full = linkage.with_passages(got, rel)
    assert rows(full.select(*want.columns)) == rows(want)
    assert "CoGroup" in got._jdf.queryExecution().optimizedPlan().toString()  # pairs are made in the tasks, not as rows
    assert linkage.best_scored(cases, names, rel.limit(0), 3).count() == 0


def test_verdicts(spark):
    S = "case_key string, press_id long, group_rank int, score double, name string, passage string"
    scores = spark.createDataFrame([("a", 1, 0, 0.9, "n", "p"), ("a", 2, 0, 0.8, "n", "p"), ("a", 3, 1, 0.8, "n", "p"), ("b", 4, 1, 0.7, "n", "p"), ("c", 5, 1, 0.7, "n", "p"), ("d", 6, 1, 0.7, "n", ""), ("e", 7, 4, 0.89, "n", "p"), ("g", 8, 0, 0.6, "n", "p")], S)
    cases = spark.createDataFrame([(k,) for k in "abcdefg"], "case_key string")
    first = linkage.initial_status(cases, scores, spark.createDataFrame([("c",), ("f",), ("f",)], "case_key string"))
    got = {r.case_key: r for r in first.collect()}
    assert [got[k].status for k in "abcdefg"] == ["confirmed", "needs_review", "confirmed", "needs_review", "confirmed", "confirmed", "needs_review"]
    assert got["e"].press_ids == [] and got["f"].confidence == 1.0 and got["f"].signals == ["ag_index_exact_match"]
    assert [tuple(r) for r in linkage.secondary(scores).collect()] == [("a", 2, 0.8)]
    verdicts = spark.createDataFrame([("b", 4, 0.95, "yes"), ("c", None, 0.0, "none fits"), ("d", None, 0.0, "LLM_ERROR: 503"), ("g", 99, 0.9, "no candidate")], "case_key string, press_id long, confidence double, explanation string")
    more = spark.createDataFrame([("a", 2), ("a", 1), ("c", 5)], "case_key string, press_id long")
    final = linkage.final_status(first, scores, verdicts, more)
    end = {r.case_key: r for r in final.collect()}
    assert (end["a"].press_ids, end["a"].status) == ([1, 2], "confirmed") and end["a"].signals[-1] == "llm_secondary_pr_confirmed:2"
    assert (end["b"].press_ids, end["b"].status, end["b"].confidence) == ([4], "confirmed", 0.95) and end["b"].signals[-1] == "llm_multi_case_batch(0.95)"
    assert (end["c"].status, end["c"].reason, end["c"].signals) == ("unmatched", "LLM rejected all candidates", ["ag_index_exact_match", "llm_multi_case_batch_rejected"])
    assert (end["d"].status, end["d"].signals) == ("unmatched", ["llm_unavailable"])  # no release and no sheet
    assert end["e"].status == end["g"].status == "unmatched" and end["f"].status == "confirmed"
    assert tuple(linkage.run_statistics(final).first()) == (7, 3, 0, 4, 4)


def test_undated_releases_are_candidates(spark):
    names = spark.createDataFrame([("dated", "Ram Lal Thapa"), ("undated", "Hari Man Rai"), ("other", "Gopal Ghale")], "case_key string, name string")
    rel = spark.createDataFrame([(1, None, "a case against Ram Lal Thapa and Hari Man Rai", "against Ram Lal Thapa and another"), (2, "", "a case against Hari Man Rai", "a case against Hari Man Rai"), (3, "2080-01-10", "against Hari Man Rai", "")], "press_id long, dated string, text string, title string")
    pairs = linkage.undated(names, rel)
    assert rows(pairs) == [("dated", 1, 4), ("undated", 1, 4), ("undated", 2, 4)]
    assert {r.status for r in linkage.best(linkage.scored(pairs, names, rel)).collect()} == {"matched"}


def test_small_scans_are_dealt_out(spark, small, tmp_path):
    df = spread(spark.read.parquet(f"{small}/court_case_hearings.parquet").select("id", "judge_names"), "id")
    assert df.rdd.getNumPartitions() == 8 and df.count() == spark.read.parquet(f"{small}/court_case_hearings.parquet").count()


def test_saves(spark):
    cases = spark.createDataFrame([("a", "pending", "t", '{"k": "1"}'), ("b", "enriched", "t", None), ("c", None, None, None)], "n string, status string, kind string, extra string")
    parties = spark.createDataFrame([("a", "old"), ("b", "kept")], "n string, name string")
    details = spark.createDataFrame([("a", None, '{"j": "2"}'), ("b", "new", None), ("z", "new", None)], "n string, kind string, extra string")
    got, who = upsert.save_details(cases, parties, details, spark.createDataFrame([("a", "new"), ("b", "new"), ("z", "new")], "n string, name string"), ["n"], "status", "enriched", "extra")
    assert rows(got, "n") == [("a", "enriched", "t", '{"k":"1","j":"2"}'), ("b", "enriched", "t", None), ("c", None, None, None)]
    assert rows(who, "n") == [("a", "new"), ("b", "kept")]
    L = "n string, kind string, day int, court string"
    listed = spark.createDataFrame([("a", None, 1, "x"), ("d", "first", 2, "x"), ("d", "second", 3, "x"), ("e", "k", 9, "x")], L)
    ledger = spark.createDataFrame([("x", 9)], "court string, day int")
    hearings = spark.createDataFrame([], "n string, day int, note string")
    one = upsert.save_listing(cases.select("n", "kind"), hearings, ledger, listed, ["n"], ["court", "day"])
    assert rows(one[0], "n") == [("a", "t"), ("b", "t"), ("c", None), ("d", "first")] and one[1].count() == 3 and one[2].count() == 4
    again = upsert.save_listing(*one, listed, ["n"], ["court", "day"])
    assert rows(again[0], "n") == rows(one[0], "n") and again[1].count() == 3


def test_outcomes_and_watermarks(spark):
    t = lambda d: datetime(2024, 1, d)
    ev = spark.createDataFrame([("a", t(1), "odd"), ("a", t(2), "success"), ("b", t(1), "too_early"), ("c", t(1), "permanent"), ("d", t(5), "success"), ("d", t(6), None), *[("e", t(i), "x") for i in range(1, 6)]], "k string, at timestamp_ntz, o string")
    got = statefold.outcome_state(ev, "k", "at", "o", F.to_timestamp_ntz(F.lit("2024-02-15 00:00:00")))
    assert rows(got, "k") == [("a", "done", 0, False), ("b", "waiting", 0, True), ("c", "failed", 0, False), ("d", "retrying", 1, True), ("e", "failed", 5, False)]
    n = spark.createDataFrame([("k", i) for i in (1, 2, 5, 20, 21)], "k string, n long")
    assert rows(ranking.last_before_gap(n, ["k"], "n", 10)) == [("k", 1, 5)] and ranking.watermark(n, "n", 99).first().high == 99 and ranking.watermark(n.limit(0), "n", 7).first().high == 7
    assert [r.n for r in ranking.keyset(n, ["k", "n"], ["k", 2], 2).collect()] == [5, 20]
    with pytest.raises(Exception, match="unknown k"):
        matching.lookup_or_fail(n, "k", spark.createDataFrame([("z", "v")], "id string, v string"), "id", "v").collect()


def test_nested_records_make_no_rows_of_pairs(spark, small):
    import __spark_entry__ as entry

    plan = entry.queries()["nested_records"](spark, small)._jdf.queryExecution().optimizedPlan().toString()
    assert "CoGroup" in plan and "passage" not in plan
