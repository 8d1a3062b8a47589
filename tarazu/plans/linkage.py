"""The deterministic record linkage: candidates by month, a name score, the best per case, verdicts, and nested records."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarazu.functions.dates import with_parts
from tarazu.functions.similarity import LEAST, LONG_TEXT, SHORTEST, Names, found_passage, matched_passage, name_score
from tarazu.functions.text import is_error_reply, match_form, spelling_form
from tarazu.operators.ranking import top_per_key

DAYS = 3  # dated releases further from the registration are no candidates
DATED, UNDATED = 0.85, 0.90  # least scores
REVIEW = 0.0  # confidence above which a case is to be reviewed
SECOND = 0.75  # least score of further releases of the best one's day
# Honorifics that are no word of a name.
TITLE_WORDS = ["श्रि", "माननिय", "डा.", "प्रा.", "अध्यक्ष", "सदस्य", "सचिव"]


def _numbered(df: DataFrame) -> DataFrame:
    cut = with_parts(df, "dated")
    month = F.when(F.col("_bs2").between(1, 12), F.col("_bs1") * 12 + F.col("_bs2"))
    return cut.withColumn("_m", month).withColumn("_d", F.col("_bs1") * 365 + F.col("_bs2") * 30 + F.col("_bs3"))


def _words(c: Column | str) -> Column:
    return F.filter(F.split(spelling_form(c), " "), lambda x: (F.length(x) > 2) & ~x.isin(*TITLE_WORDS))


def _ends(words: Column | str) -> Column:
    return F.filter(F.array(F.get(words, F.lit(0)), F.try_element_at(words, F.lit(-1))), lambda x: x.isNotNull())


def candidates(cases: DataFrame, releases: DataFrame) -> DataFrame:
    """case_key, press_id, group_rank: 0 for the same day, 1..DAYS for days apart, DAYS + 1 for undated releases.

    cases: case_key, dated; releases: press_id, dated. Joined on month buckets (own and both neighbours);
    a release of the bucket without a day is undated. Those without a month are candidates by undated().
    """
    numbered = lambda df: _numbered(df).where(F.col("_m").isNotNull())
    c = numbered(cases.select("case_key", "dated"))
    c = c.withColumn("_b", F.explode(F.array(F.col("_m") - 1, F.col("_m"), F.col("_m") + 1)))
    r = numbered(releases.select("press_id", "dated")).select("press_id", F.col("_m").alias("_b"), F.col("_d").alias("_rd"))
    gap = F.abs(F.col("_rd") - F.col("_d"))
    rank = F.when(F.col("_rd").isNull() | F.col("_d").isNull(), DAYS + 1).when(gap <= DAYS, gap)
    return c.join(r, "_b").select("case_key", "press_id", rank.cast("int").alias("group_rank")).where(F.col("group_rank").isNotNull())


def undated(names: DataFrame, releases: DataFrame) -> DataFrame:
    """case_key, press_id, group_rank DAYS + 1: the releases without a month, for every case, dated or not, of which they hold the first or the last word of a name.

    A release that lacks both, or one of them in anything like its spelling, scores under LEAST, so middle names make no pairs.

    names: case_key, name; releases: press_id, dated, text.
    """
    free = _numbered(releases.select("press_id", "dated", "text")).where(F.col("_m").isNull()).select("press_id", F.explode(F.array_distinct(_words("text"))).alias("_t"))
    who = names.select("case_key", _words("name").alias("w")).select("case_key", F.explode(_ends("w")).alias("_t")).distinct()
    return who.join(free, "_t").select("case_key", "press_id", F.lit(DAYS + 1).alias("group_rank")).distinct()


def all_candidates(cases: DataFrame, names: DataFrame, releases: DataFrame) -> DataFrame:
    """Dated and undated candidates. cases: case_key, dated; names: case_key, name; releases: press_id, dated, text."""
    return candidates(cases, releases).unionByName(undated(names, releases))


def scored(pairs: DataFrame, names: DataFrame, releases: DataFrame) -> DataFrame:
    """pairs with score, name and passage: the best of the case's names in the release, where it is LEAST or more.

    names: case_key, name, and pos, their order, if there is one; releases: press_id, title, text. Of equal scores the first name counts.
    A release whose passage is shorter than SHORTEST is rejected. The similarity runs once for each distinct (name, release) pair.
    """
    place = F.min("pos") if "pos" in names.columns else F.lit(0)
    names = names.groupBy("case_key", "name").agg(place.alias("pos"))
    read = releases.select("press_id", match_form("text").alias("_text"), F.col("text").alias("_full"), F.coalesce("title", F.lit("")).alias("_title"))
    each = pairs.join(names, "case_key").select("case_key", "press_id", "group_rank", "name", "pos")
    n = 2 * pairs.sparkSession.sparkContext.defaultParallelism  # few pairs of long texts: more tasks than their bytes would give
    distinct = each.select("name", "press_id").distinct().repartition(max(n, int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "name", "press_id").join(read, "press_id").select("name", "press_id", name_score()(match_form("name"), "_text", "name", "_full", "_title").alias("s"))
    best = each.join(distinct, ["name", "press_id"]).groupBy("case_key", "press_id", "group_rank").agg(F.max_by(F.struct("s.score", "name", "s.passage"), F.struct("s.score", -F.col("pos"), "name")).alias("b"))
    told = F.coalesce(F.length(F.trim("b.passage")) >= SHORTEST, F.lit(False)) | (F.coalesce("b.passage", F.lit("")) == "")
    return best.where(told & (F.col("b.score") >= LEAST)).select("case_key", "press_id", "group_rank", "b.*")


def _name_order(name: pd.Series) -> pd.Series:
    """Numbers in the order of the names' code points."""
    return name.map({x: i for i, x in enumerate(sorted(name.unique()))})


def _search(k: int):
    """The k best releases of each case in one group: a month of releases with the cases around it, or all undated releases with a block of cases."""

    def run(key: tuple, who: pd.DataFrame, rel: pd.DataFrame) -> pd.DataFrame:
        columns = ["case_key", "press_id", "group_rank", "score", "name"]
        if who.empty or rel.empty:
            return pd.DataFrame({c: [] for c in columns}, dtype=object)
        undated = bool(key[0])
        number, one = pd.factorize(who["name"])
        forms = who["form"].fillna("").to_numpy()[np.unique(number, return_index=True)[1]]
        names = Names(list(forms), list(one))
        case, _ = pd.factorize(who["case_key"])
        of_name = np.argsort(number, kind="stable")
        starts = np.searchsorted(number[of_name], np.arange(len(one) + 1))
        day = who["d"].to_numpy(dtype=float)  # nan where there is none
        holders: dict[str, set[int]] = {}
        rows_of: dict[int, list[int]] = {}
        if undated:
            for i, (c, ends) in enumerate(zip(case.tolist(), who["ends"])):
                rows_of.setdefault(c, []).append(i)
                for w in ends:
                    holders.setdefault(w, set()).add(c)
        known: dict[str, tuple[np.ndarray, np.ndarray]] = {}  # the scores of a text that comes again; -1 where not asked
        again = set(rel["text"][rel["text"].duplicated()])
        got = []
        for at, r in enumerate(rel.itertuples(index=False)):
            if undated:
                cases = set().union(*(holders.get(w, ()) for w in r.words))
                rows = np.array(sorted(i for c in cases for i in rows_of[c]), dtype=np.int64)
                rank = np.full(len(who), DAYS + 1)
            else:
                gap = np.abs(day - (np.nan if r.d is None else r.d))
                rows = np.flatnonzero(~(gap > DAYS))
                rank = np.where(np.isnan(gap), DAYS + 1, gap)
            if not len(rows):
                continue
            which = np.unique(number[rows])
            if r.text in again:
                score, asked = known.setdefault(r.text, (np.zeros(len(one)), np.zeros(len(one), dtype=bool)))
                new = which[~asked[which]]
                hit, found = names.scores(new, r.text)
                score[hit], asked[new] = found, True
                hit = which[score[which] >= LEAST]
                found = score[hit]
            else:
                hit, found = names.scores(which, r.text)
            if not len(hit):
                continue
            best = np.zeros(len(one))
            best[hit] = found
            rows = rows[best[number[rows]] > 0]
            got.append(pd.DataFrame({"row": rows, "at": at, "score": best[number[rows]], "group_rank": rank[rows].astype(int)}))
        if not got:
            return pd.DataFrame({c: [] for c in columns}, dtype=object)
        got = pd.concat(got, ignore_index=True)
        got["case"], got["pos"], got["order"] = case[got["row"]], who["pos"].to_numpy()[got["row"]], _name_order(who["name"]).to_numpy()[got["row"]]
        got = got.sort_values(["score", "pos", "order"], ascending=[False, True, False], kind="stable").drop_duplicates(["case", "at"])
        told = rel["told"].to_numpy(dtype=object)
        full = rel["full"].to_numpy(dtype=object)
        unsure = np.array([x is None for x in told])
        keep = np.array([True if unsure[a] else bool(told[a]) for a in got["at"]], dtype=bool)
        for i in np.flatnonzero(unsure[got["at"].to_numpy()]):
            passage = matched_passage(who["name"].iat[got["row"].iat[i]], full[got["at"].iat[i]] or "", "", True)
            keep[i] = passage == "" or len(passage.strip(" ")) >= SHORTEST
        got = got[keep]
        got["press_id"] = rel["press_id"].to_numpy()[got["at"]]
        got = got.sort_values(["case", "score", "group_rank", "press_id"], ascending=[True, False, True, True], kind="stable").groupby("case", sort=False).head(k)
        return pd.DataFrame({"case_key": who["case_key"].to_numpy()[got["row"]], "press_id": got["press_id"].to_numpy(), "group_rank": got["group_rank"].to_numpy(), "score": got["score"].to_numpy(), "name": who["name"].to_numpy()[got["row"]]}, columns=columns)

    return run


def best_scored(cases: DataFrame, names: DataFrame, releases: DataFrame, k: int = 1) -> DataFrame:
    """best(scored(all_candidates(cases, names, releases), names, releases), k) without the passages, for many releases a month.

    The pairs grow with the square of the tables, so none is a row: a group of cases meets a group of releases in one task, each text
    is searched for all its names at once, and only the k best of a case leave it. Groups are the months of the releases with the cases
    of three months, and the undated releases with each block of the cases.
    """
    spark = cases.sparkSession
    blocks = max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    place = F.min("pos") if "pos" in names.columns else F.lit(0)
    said = names.where(F.col("case_key").isNotNull() & F.col("name").isNotNull()).groupBy("case_key", "name").agg(place.cast("long").alias("pos"))
    said = said.select("case_key", "name", "pos", match_form("name").alias("form"))
    day = F.col("_d").cast("long").alias("d")
    near = _numbered(cases.select("case_key", "dated")).where(F.col("_m").isNotNull()).select("case_key", day, F.explode(F.array(F.col("_m") - 1, F.col("_m"), F.col("_m") + 1).cast("array<long>")).alias("b"))
    dated = said.join(near, "case_key").select(F.lit(False).alias("free"), "b", "case_key", "name", "pos", "form", "d", F.array().cast("array<string>").alias("ends"))
    every = said.select(F.lit(True).alias("free"), F.pmod(F.xxhash64("case_key"), F.lit(blocks)).cast("long").alias("b"), "case_key", "name", "pos", "form", F.lit(None).cast("long").alias("d"), _ends(_words("name")).alias("ends"))
    text, full, title = match_form("text"), F.coalesce("text", F.lit("")), F.coalesce("title", F.lit(""))
    # a window of 50 letters or more has a passage of SHORTEST, unless there is much white space
    odd = (F.length(full) < 50) | full.rlike(r"[\s\p{Z}\x{85}\x{1c}-\x{1f}]{15}")
    told = F.when(F.length("text") <= LONG_TEXT, (F.length(F.trim("title")) >= SHORTEST) | (F.col("title") == "")).when(~F.col("odd"), True)
    read = _numbered(releases.where(F.col("press_id").isNotNull()).select("press_id", "dated", text.alias("form"), full.alias("full"), title.alias("title"), odd.alias("odd"), "text"))
    read = read.select("press_id", "_m", day, F.col("form").alias("text"), F.when(F.col("odd"), F.col("full")).alias("full"), "title", "odd", F.when(F.col("_m").isNull(), F.array_distinct(_words("text"))).alias("words"))
    read = read.select("press_id", "_m", "d", "text", "full", told.alias("told"), F.coalesce("words", F.array().cast("array<string>")).alias("words"))
    of_month = read.where(F.col("_m").isNotNull()).select(F.lit(False).alias("free"), F.col("_m").cast("long").alias("b"), "press_id", "d", "text", "full", "told", "words")
    free = read.where(F.col("_m").isNull()).select(F.lit(True).alias("free"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)).cast("array<long>")).alias("b"), "press_id", "d", "text", "full", "told", "words")
    side = lambda a, b: a.unionByName(b).repartition(2 * blocks, "free", "b").groupBy("free", "b")  # noqa: E731  # small rows, long work: more tasks than their bytes would give
    found = side(dated, every).cogroup(side(of_month, free)).applyInPandas(_search(k), "case_key string, press_id long, group_rank int, score double, name string")
    return best(found, k)


def with_passages(found: DataFrame, releases: DataFrame) -> DataFrame:
    """found (case_key, press_id, name, ...) with the passage of each release that names the name."""
    read = releases.select("press_id", F.length(match_form("text")).alias("_n"), F.col("text").alias("_full"), F.coalesce("title", F.lit("")).alias("_title"))
    n = 2 * found.sparkSession.sparkContext.defaultParallelism  # as in scored()
    spread = found.repartition(max(n, int(found.sparkSession.conf.get("spark.sql.shuffle.partitions"))), "press_id")
    return spread.join(read, "press_id").withColumn("passage", found_passage()("name", "_full", "_title", F.col("_n") > LONG_TEXT)).drop("_n", "_full", "_title")


def signals() -> Column:
    """What speaks for a scored pair, as strings."""
    said = F.array(F.format_string("defendant_name_similarity(%.2f)", "score"), F.concat(F.lit("matched_defendant:"), "name"), F.when(F.col("passage") != "", F.concat(F.lit("pr_matched_text:"), "passage")))
    return F.filter(said, lambda x: x.isNotNull())


def least_score() -> Column:
    return F.when(F.col("group_rank") > DAYS, UNDATED).otherwise(DATED)


def best(scores: DataFrame, k: int = 1) -> DataFrame:
    """The k best releases of each case: score, then the nearer day, then the smaller id; with the threshold applied as status."""
    top = top_per_key(scores, ["case_key"], [F.desc("score"), F.asc("group_rank"), F.asc("press_id")], k)
    return top.withColumn("status", F.when(F.col("score") >= least_score(), "matched").when(F.col("score") >= LEAST, "needs_review").otherwise("unmatched"))


def secondary(scores: DataFrame) -> DataFrame:
    """case_key, press_id, score: further releases of the same day group as a case's matched best one, of SECOND or more; undated groups have none."""
    top = best(scores).where((F.col("status") == "matched") & (F.col("group_rank") <= DAYS)).select("case_key", "group_rank", F.col("press_id").alias("_best"))
    return scores.join(top, ["case_key", "group_rank"]).where((F.col("press_id") != F.col("_best")) & (F.col("score") >= SECOND)).select("case_key", "press_id", "score")


def initial_status(cases: DataFrame, scores: DataFrame, sheets: DataFrame, adjudicated: bool = True) -> DataFrame:
    """case_key, press_ids, has_sheet, confidence, status, signals of every case before an adjudicator speaks.

    confidence is the greater of the release's score and 1 for a sheet of the case's number, to four places. Below its threshold
    the best release is not attached; its score stays if an adjudicator will be asked. scores: see scored(); sheets: case_key.
    """
    one = best(scores).withColumn("_said", signals())
    hit = F.col("status") == "matched"
    kept = one.select("case_key", F.when(hit, F.array("press_id")).otherwise(F.array().cast("array<long>")).alias("press_ids"), F.when(hit | F.lit(adjudicated), F.col("score")).otherwise(0.0).alias("score"), F.when(hit | F.lit(adjudicated), F.col("_said")).alias("_said"))
    held = sheets.select("case_key").distinct().withColumn("has_sheet", F.lit(True))
    all_ = cases.select("case_key").distinct().join(kept, "case_key", "left").join(held, "case_key", "left")
    sheet = F.coalesce("has_sheet", F.lit(False))
    confidence = F.round(F.greatest(F.coalesce("score", F.lit(0.0)), sheet.cast("double")), 4)
    none = F.array().cast("array<string>")
    said = F.concat(F.coalesce("_said", none), F.when(sheet, F.array(F.lit("ag_index_exact_match"))).otherwise(none))
    rows = all_.select("case_key", F.coalesce("press_ids", F.array().cast("array<long>")).alias("press_ids"), sheet.alias("has_sheet"), confidence.alias("confidence"), said.alias("signals"))
    return rows.withColumn("status", F.when(F.col("confidence") >= DATED, "confirmed").when(F.col("confidence") > REVIEW, "needs_review").otherwise("unmatched"))


def final_status(initial: DataFrame, scores: DataFrame, verdicts: DataFrame, additional: DataFrame) -> DataFrame:
    """initial with an adjudicator's verdicts applied, and a reason where a case stays unmatched.

    verdicts: case_key, press_id (null for none), confidence, explanation; additional: case_key, press_id of further releases.
    A release it names among the case's candidates replaces the others, and of the signals only those of sheets stay beside the
    candidate's. An error leaves the case to be reviewed; a rejection leaves it unmatched even with a sheet. Further releases are
    attached once, to cases that have one. Last, what has neither release nor sheet is unmatched.
    """
    v = verdicts.select("case_key", F.col("press_id").alias("_p"), F.col("confidence").alias("_c"), "explanation", F.lit(True).alias("_asked"))
    cand = scores.select("case_key", F.col("press_id").alias("_p"), signals().alias("_said"))
    extra = additional.groupBy("case_key").agg(F.sort_array(F.collect_set("press_id")).alias("_more"))
    df = initial.join(v, "case_key", "left").join(cand, ["case_key", "_p"], "left").join(extra, "case_key", "left")
    named, failed = F.col("_p").isNotNull() & F.col("_said").isNotNull(), F.col("_asked") & F.col("_p").isNull() & is_error_reply("explanation")
    refused = F.col("_asked") & F.col("_p").isNull() & ~is_error_reply("explanation")
    bare = F.filter("signals", lambda x: ~x.rlike("^(pr_matched_text:|date_match:|defendant_name_similarity|matched_defendant:)"))
    sure = F.when(named, F.greatest("confidence", "_c")).otherwise(F.col("confidence"))
    ids = F.when(named, F.array("_p")).when(refused, F.array().cast("array<long>")).otherwise(F.col("press_ids"))
    said = (
        F.when(named, F.concat(F.filter("signals", lambda x: x.startswith("ag_index_")), "_said", F.array(F.format_string("llm_multi_case_batch(%.2f)", "_c"))))
        .when(failed, F.concat("signals", F.array(F.lit("llm_unavailable"))))
        .when(refused, F.concat(bare, F.array(F.lit("llm_multi_case_batch_rejected"))))
        .otherwise(F.col("signals"))
    )
    status = F.when(named, F.when(sure >= DATED, "confirmed").otherwise("needs_review")).when(failed, "needs_review").when(refused, "unmatched").otherwise(F.col("status"))
    reason = F.when(refused, "LLM rejected all candidates")
    df = df.select("case_key", "has_sheet", "_more", sure.alias("confidence"), ids.alias("press_ids"), said.alias("signals"), status.alias("status"), reason.alias("reason"))
    new = F.when(F.size("press_ids") > 0, F.array_except(F.coalesce("_more", F.array().cast("array<long>")), "press_ids")).otherwise(F.array().cast("array<long>"))
    df = df.withColumn("_new", new)
    df = df.select("case_key", "has_sheet", "confidence", "status", "reason", F.concat("press_ids", "_new").alias("press_ids"), F.concat("signals", F.transform("_new", lambda x: F.concat(F.lit("llm_secondary_pr_confirmed:"), x.cast("string")))).alias("signals"))
    empty = F.col("status").isin("confirmed", "needs_review") & (F.size("press_ids") == 0) & ~F.col("has_sheet")
    why = F.when(empty, "No press release or charge sheet populated").when(F.col("status") == "unmatched", F.coalesce("reason", F.lit("No press release or charge sheet matched above threshold")))
    return df.select("case_key", "press_ids", "has_sheet", "confidence", F.when(empty, F.lit("unmatched")).otherwise(F.col("status")).alias("status"), F.when(empty, bare).otherwise(F.col("signals")).alias("signals"), why.alias("reason"))


def run_statistics(final: DataFrame) -> DataFrame:
    """total, confirmed, needs_review, unmatched, written: one row of counts over a run's cases; written are those with a release or sheet."""
    n = lambda s: F.count_if(F.col("status") == s).alias(s)
    return final.agg(F.count(F.lit(1)).alias("total"), n("confirmed"), n("needs_review"), n("unmatched"), F.count_if((F.size("press_ids") > 0) | F.col("has_sheet")).alias("written"))


def nested(cases: DataFrame, matches: DataFrame, sheets: DataFrame, parties: DataFrame) -> DataFrame:
    """One record a case: its parties, its releases and its sheets as arrays of structs, in order; ready for a JSON sink."""
    rel = matches.where("status = 'matched'").groupBy("case_key").agg(F.sort_array(F.collect_list(F.struct("press_id", "score"))).alias("releases"))
    sh = sheets.groupBy("case_key").agg(F.sort_array(F.collect_list(F.struct("charge_id", "title"))).alias("sheets"))
    who = parties.groupBy("case_key").agg(F.sort_array(F.collect_set(F.struct("side", "name"))).alias("parties"))
    return cases.join(who, "case_key", "left").join(rel, "case_key", "left").join(sh, "case_key", "left")
