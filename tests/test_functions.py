"""Text, value and similarity functions on the reference expectations."""

from __future__ import annotations

from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from curatrix.functions import fuzzy, text, values


def over(spark, rows, *columns):
    """Column values over rows of one text each."""
    df = spark.createDataFrame([(k, r) for k, r in enumerate(rows)], "k int, s string")
    got = df.select("k", *[c.alias(f"c{i}") for i, c in enumerate(columns)]).orderBy("k").collect()
    return [r[1] if len(columns) == 1 else tuple(r)[1:] for r in got]




def test_match_text(spark):
    assert over(spark, ["  Hello  World!  ", "Beyoncé", "A_B-C.D,E", None, "x 　y"], text.match_text(F.col("s"))) == ["hello world", "beyonce", "a_b-c.d,e", "", "x y"]
    assert over(spark, ["The Beatles", "Theory"], text.match_artist(F.col("s"))) == ["beatles", "theory"]


def test_display_text(spark):
    rows = ["Beyoncé", "A B", "D´Argent", "～", "R%C3%9CF%C3%9CS DU SOL", "https://x.org/%20a", "a​b\u0007c", "1+1%2B2 %zz", None]
    assert over(spark, rows, text.display_text(F.col("s"))) == ["Beyoncé", "A B", "D'Argent", "~", "RÜFÜS DU SOL", "https://x.org/%20a", "abc", "1+1+2 %zz", ""]
    assert [text.shown(r) for r in rows] == over(spark, rows, text.display_text(F.col("s")))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(max_size=20), min_size=1, max_size=20))
def test_sql_functions_agree_with_columns(spark, rows):
    clean = [r.replace("\x00", "").encode("utf-8", "ignore").decode() for r in rows]
    assert over(spark, clean, text.match_text(F.col("s"))) == [text.searched(r) for r in clean]


def test_separators_are_white_space(spark):
    rows = ["0\x1f0", "a\x1cb", " \x1d\x1e x", "\U00031350 É"]  # the last has a letter newer than some JVMs
    assert over(spark, rows, text.match_text(F.col("s"))) == ["0 0", "a b", "x", "\U00031350 e"]
    assert over(spark, rows[:3], text.clean(F.col("s"))) == ["0 0", "a b", "x"]


def test_udfs_see_only_the_rows_that_need_them():
    import pandas as pd

    seen = []
    got = text.changed(pd.Series([None, "é", None]), lambda v: seen.append(v) or "e")
    assert seen == ["é"] and got.tolist() == [None, "e", None]
    assert text.changed(pd.Series([None, None]), seen.append).isna().all() and seen == ["é"]


def test_song_keys(spark):
    assert over(spark, ["The Song (Live) feat. X", "Rock & Roll", "Don't Stop", "Café [Demo]"], text.song_key(F.col("s"))) == ["song", "rock and roll", "dont stop", "cafe"]
    assert over(spark, ["The Song (Live)"], text.merge_key(F.col("s"))) == ["song live"]
    assert over(spark, ["The Beatles", "The"], text.compact_artist(F.col("s"))) == ["beatles", "the"]


def test_title_cleaning(spark):
    assert over(spark, ["Song (Official Video)", "Song [HD]", "Song - Official Audio x", "Song | Topic", "Song #tag more"], text.clean_title(F.col("s"))) == ["Song"] * 5
    assert over(spark, ["Song - Radio Edit", "Song (2011 Remastered)", "Song"], text.title_core(F.col("s"))) == ["song"] * 3
    assert over(spark, ["1. Abba", "- Abba", "Songs Like Abba", "IV. Abba"], text.clean_list_artist(F.col("s"))) == ["Abba"] * 4
    assert over(spark, ["Abba feat. Cher", "Abba"], text.lead_artist(F.col("s"))) == ["Abba", "Abba"]
    assert over(spark, ["Artist - Song", "Plain"], text.looks_suspicious(F.col("s"), F.lit("x"))) == [True, False]
    assert over(spark, ["Abba Waterloo"], text.artist_without_title(F.col("s"), F.lit("Waterloo"))) == ["Abba"]


def test_repair(spark):
    broken = "Beyoncé".encode().decode("latin-1")
    assert over(spark, [broken, "fine", None], text.repaired(F.col("s"))) == ["Beyoncé", "fine", ""]


def test_stable_id(spark):
    same = [("Hello", "The Who"), ("  hello ", "the who"), ("HELLO!", "Who")]
    df = spark.createDataFrame([(*p, "") for p in same] + [("Hello", "Who", "Live")], "t string, a string, v string")
    ids = [r[0] for r in df.select(values.stable_id(F.col("t"), F.col("a"), F.col("v"))).collect()]
    plain = [r[0] for r in df.limit(1).select(values.stable_id(F.col("t"), F.col("a"))).collect()]
    assert len(set(ids[:3])) == 1 and ids[3] != ids[0] and plain[0] == ids[0]


def test_durations_and_numbers(spark):
    rows = ["3:05", "1:02:03", "x", None, "03:07"]
    assert over(spark, rows, values.duration_seconds(F.col("s"))) == [185, 3723, None, None, 187]
    assert over(spark, rows, values.compact_duration(F.col("s"))) == ["3:05", "1 02 03", "x", "", "3:07"]
    assert over(spark, ["1995.0", "3.5", "x", ""], values.numeric_string(F.col("s"))) == ["1995", "3.5", None, None]
    assert over(spark, ["185000", "59500", "", "x"], values.duration_from_ms(F.col("s"))) == ["3:05", "1:00", "", ""]
    assert over(spark, ["61999"], values.duration_from_ms(F.col("s"), floor=True)) == ["1:01"]
    assert over(spark, ["rel. 1999-02", "1850", "in 2024!"], values.year_in(F.col("s"))) == [1999, None, 2024]


def test_lists(spark):
    assert over(spark, ["a; B;b ;;A; c"], values.semicolon_join(values.listed(F.col("s")))) == ["a; B; c"]
    assert over(spark, ["a; b"], values.added_to_list(F.col("s"), F.lit("b; c"))) == ["a; b; c"]
    assert over(spark, ["a;b", ""], values.jaccard(values.listed(F.col("s")), values.listed(F.lit("b;c")))) == [pytest.approx(1 / 3), 0.0]
    assert over(spark, ["Song (Live) Remastered", "Song"], values.infer_version(F.col("s"), F.lit("Demo"))) == ["live; remastered; demo", "demo"]
    assert over(spark, ["Song"], values.infer_version(F.col("s"), F.lit(""))) == [values.NO_VERSION]


def test_scores(spark):
    assert over(spark, ["120", "122", "140", None], values.bpm_score(F.lit(120), F.col("s").try_cast("double"))) == [10.0, pytest.approx(10 * (1 - 2 / 15)), 0.0, 0.0]
    assert over(spark, ["C", "Am", "D", ""], values.key_score(F.lit("C"), F.col("s"))) == [5.0, 3.0, 0.0, 0.0]
    assert over(spark, ["Abba", "abba live", "Cher", ""], values.agreement(F.lit("ABBA"), F.col("s"))) == ["exact", "partial", "different", "different"]
    assert over(spark, ["Song remastered", "Song live", "Song 7 inch", "Song"], values.edition_score(F.col("s"))) == [4, -8, -3, 0]
    assert over(spark, ["900"], values.score_text(F.col("s").cast("int"))) == ["0.900"]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.text("abcd ", max_size=12), st.text("abcd ", max_size=12)), min_size=1, max_size=20))
def test_ratios(spark, pairs):
    df = spark.createDataFrame([(k, *p) for k, p in enumerate(pairs)], "k int, a string, b string")
    got = df.select("k", fuzzy.sequence_ratio(F.col("a"), F.col("b")), fuzzy.indel_ratio(F.col("a"), F.col("b"))).orderBy("k").collect()

    def lcs(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            row, last = [0, *row[1:]], row
            for j, y in enumerate(b):
                row[j + 1] = last[j] + 1 if x == y else max(row[j], last[j + 1])
        return row[-1]

    for (a, b), (_, s, i) in zip(pairs, got, strict=True):
        assert s == pytest.approx(1.0 if a == b and a else SequenceMatcher(None, a, b).ratio() if a and b else 0.0)
        assert i == pytest.approx(2 * lcs(a, b) / (len(a) + len(b)) if a or b else 1.0)


def test_best_match(spark):
    df = spark.createDataFrame([("Song A", "Artist X", "Song A (Official Video)", "Artist X"), ("Song A", "Artist X", "Other", "Nobody")], "t string, a string, u string, b string")
    got = [r[0] for r in df.select(fuzzy.match_score(*[F.col(c) for c in "taub"])).collect()]
    assert got[0] >= 0.95 and got[1] < 0.7


def test_validation(spark):
    df = spark.createDataFrame([("R1", "S1", "5", "3"), ("R1", "", "15", "x")], "r string, s string, e string, d string")
    got = [r[0] for r in df.select(values.validation_errors({"Song ID": F.col("s")}, {"Energy": (F.col("e"), 1, 10), "Difficulty": (F.col("d"), 1, 5)})).collect()]
    assert got == [[], ["Missing required field: Song ID", "Energy must be between 1 and 10", "Difficulty must be an integer"]]


def test_rows_of_ascii_reach_no_udf(spark):
    from curatrix.operators import rows
    from curatrix.plans import catalogue

    texts = ["03:05", "The Song (Live) feat. X", "Café [Demo]", "Don't Stop & Go", "½ Ⅳ:05", "0７:05", "", None, "a\x1cb", "99999999999999999999:00"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    key = lambda k: lambda d: d.select("s", values.compact_duration(F.col("s"), k).alias("c"))
    got = rows.apart(df, text.has_non_ascii(F.col("s")), key(text.song_key), key(text.ascii_song_key))
    assert sorted(map(str, got.collect())) == sorted(map(str, key(text.song_key)(df).collect()))
    assert over(spark, texts[:4], values.compact_duration(F.col("s"))) == ["3:05", "song", "cafe", "dont stop and go"]
    plan = catalogue.QUERIES["value_parsers"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString().splitlines()
    udfs = [k for k, line in enumerate(plan) if "ArrowEvalPython" in line]
    assert len(udfs) == 1 and any("Filter" in line and "RLIKE" in line for line in plan[udfs[0] : udfs[0] + 3])
    assert not any("pythonUDF" in line for line in plan[udfs[0] + 3 :])


def test_clock_as_format_string_writes_it(spark):
    df = spark.createDataFrame([(m, s) for m in (-12, 0, 7, 130) for s in (-7, 0, 5, 9, 10, 59, 100)] + [(None, 1), (1, None)], "m long, s long")
    plain = F.when(F.col("m").isNotNull() & F.col("s").isNotNull(), F.format_string("%d:%02d", "m", "s"))
    assert all(a == b for a, b in df.select(values.clock(F.col("m"), F.col("s")), plain).collect())
