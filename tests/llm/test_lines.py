"""Line-first cleaning: hand-worked cases and odd input."""

import pytest
from pyspark.sql import functions as F

from tidepool.llm.lines import LineRules, line_quality, repeated_words, words_of

SCHEMA = "doc_id long, text string, kept string, words int"


def judge(spark, texts, **rules):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], SCHEMA)
    return {r["doc_id"]: r for r in line_quality(docs, LineRules(**rules)).collect()}


def brute_repeats(text, window):
    words = text.split()
    seen = {}
    for i in range(len(words) - window + 1):
        seen.setdefault(tuple(words[i:i + window]), []).append(i)
    return len({i + k for places in seen.values() if len(places) > 1
                for i in places for k in range(window)})


PROSE = "The river rose in the night and the people of the town went up to the old mill by day."


def test_lines_that_fail(spark):
    lines = [PROSE, "Home | About | Contact | Help", "Cookie policy applies to this whole page of ours.",
             "BUY!! NOW!! HERE!!", "No end of a sentence", "a### b$$$ c%%% d&&& e***."]
    got = judge(spark, ["\n".join(lines), PROSE + "\n" + PROSE, PROSE])
    assert got[0]["n_clean_lines"] == 1 and got[0]["n_lines"] == 6
    assert got[0]["clean_text"] == PROSE and not got[0]["kept"]
    assert got[1]["n_dup_lines"] == 1 and got[1]["n_repeat_words"] == 40 and got[1]["base_failed"]
    assert got[2]["kept"] and got[2]["n_words"] == 20
    assert not judge(spark, [PROSE], min_words=21)[0]["kept"]


@pytest.mark.parametrize("line, clean", [
    ("It rained." + " " * 200, True), ("It rained.\t\t\t\t\t\t\t\t\t\t", True), ('"It rained!"))  ', True),
    ("\u092f\u0939 \u090f\u0915 \u0935\u093e\u0915\u094d\u092f \u0939\u0948\u0964", True),
    ("\u0647\u0644 \u0647\u0630\u0627 \u0633\u0624\u0627\u0644\u061f", True),
    ("\u8fd9\u662f\u4e00\u4e2a\u53e5\u5b50\u3002\u300d", True), ("\u12ed\u1205 \u1290\u12cd\u1362", True),
    ("\u053f\u0561\u057f\u0578\u0582\u0589", True), ("No end", False), ("The 1. item", False), ('")  ', False),
    ("Ends with a comma,", False)])
def test_ends_of_lines_in_any_script(spark, line, clean):
    got = judge(spark, [line + "\n" + PROSE])[0]
    assert got["n_clean_lines"] == 1 + clean


def test_odd_texts(spark):
    got = judge(spark, [None, "", " \t\n ", "\n\n", "x"])
    for i in range(4):
        assert got[i]["n_words"] == 0 and got[i]["base_failed"] and not got[i]["kept"]
        assert got[i]["n_lines"] == 0 and got[i]["line_chars"] == 0
    assert got[4]["n_words"] == 1 and got[4]["word_chars"] == 1


def test_empty_table_and_repeated_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert line_quality(empty).count() == 0
    docs = spark.createDataFrame([(1, PROSE, "", 0)] * 3 + [(None, PROSE, None, None)], SCHEMA)
    rows = line_quality(docs).drop("doc_id").collect()
    assert len(rows) == 4 and len(set(rows)) == 1


@pytest.mark.parametrize("text", [
    "a b c d e f g h i a b c d e f g h", "a " * 50, "a b " * 9, "one two", "",
    "x " * 8, "x " * 7, "p q r s t u v w x y p q r s t u v w z", "w " * 30_000,
    " ".join(str(i % 997) for i in range(20_000))])
def test_repeated_words(spark, text):
    df = spark.createDataFrame([(text,)], "text string")
    got = df.select(repeated_words(words_of(F.col("text")), 8).alias("n")).first()["n"]
    assert got == brute_repeats(text, 8)


def test_only_functions(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    plan = line_quality(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
