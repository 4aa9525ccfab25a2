import datetime

import pytest
from pyspark.sql import functions as F

from lodestrata.functions import dates, hashing, masking, scores, text


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


@pytest.mark.parametrize(
    "note",
    ["17-123", "DFX 17-123", "protocol #17-123", "protocol 17 - 123", "17–123", "#17123", "protocol 17123", "17-123-01", "protocol 17-123/A", "x/17-123", "DFX/17-123"],
)
def test_own_protocol_is_masked(note):
    masked, n, _, _ = masking.mask_text(f"on {note} today", [17123], [], [], ("DFX",))
    assert n == 1 and "17" not in masked and masking.TOKENS["protocol"] in masked
    assert "own_protocol" not in masking.residuals(masked, [17123], [], [])


@pytest.mark.parametrize("note", ["17-124", "4.17-123", "17 123", "117-123", "17-1234", "2017-123", "range 10-200"])
def test_look_alikes_stay(note):
    assert masking.mask_text(f"on {note} today", [17123], [], []) == (f"on {note} today", 0, 0, 0)


def test_registry_ids_and_codes():
    note = "NCT01234567, nct 1234567, NCT07654321; ABC-1234 abc1234 ABC 1234 ABC12345 CD123"
    masked, _, n, c = masking.mask_text(note, [], ["1234567"], ["ABC1234"])
    assert (n, c) == (2, 3) and "NCT07654321" in masked and "ABC12345" in masked and "CD123" in masked
    assert masking.residuals("1234567 and ABC_1234 17_123 17-123/4 5.17-123", [17123], ["1234567"], ["ABC1234"]) == ["protocol_followed_by_dash_or_slash", "protocol_after_dot_dash_or_slash", "protocol_other_separator", "nct_digits_without_prefix", "code_other_separator"]


def test_masked_column_and_nulls(spark):
    rows = spark.createDataFrame([("a 17-123", [17123]), (None, [17123]), ("b", None)], "t string, p array<int>")
    found = rows.select(masking.masked(F.col("t"), F.col("p"), F.array().cast("array<string>"), F.array().cast("array<string>")).alias("m")).select("m.*").collect()
    assert [(r["text"], r["n_protocol"]) for r in found] == [("a [TRIAL PROTOCOL]", 1), (None, 0), ("b", 0)]


@pytest.mark.parametrize(
    ("note", "years"),
    [("aged 54", 54.0), ("Age 18 months", 1.5), ("age 2 years and 3 weeks", 2 + 21 / 365.2425), ("age 140", None), ("no number", None), ("age 67.5", 67.5), (None, None), ("package 12", None)],
)
def test_ages(spark, note, years):
    found = one(spark, dates.age_years(F.lit(note)))
    assert found == years or abs(found - years) < 1e-9


def test_weeks_need_years(spark):
    with pytest.raises(Exception, match="weeks"):
        one(spark, dates.age_years(F.lit("age 3 months and 2 weeks")))


def test_partial_dates(spark):
    d = datetime.date
    for value, bounds in {"2021-05": (d(2021, 5, 1), d(2021, 5, 31)), "2021-05-17": (d(2021, 5, 17), d(2021, 5, 17)), "bad": (None, None), None: (None, None), "2021-13": (None, None)}.items():
        assert tuple(one(spark, dates.partial_bounds(F.lit(value)))) == bounds
    assert one(spark, dates.parse_day(F.lit("3/4/2020"))) == d(2020, 3, 4)
    assert one(spark, dates.decade(F.lit(d(1970, 1, 1)), F.lit(d(2020, 1, 2)))) == "50-59"


def test_quotes(spark):
    found = lambda q, t: one(spark, text.quote_found(F.lit(q), F.lit(t)))
    source = "The  quick brown\nfox jumps over the dog"
    assert found("QUICK brown fox", source) and found("quick ... over … dog", source) and found("quick…fox", source)
    assert not found("over ... quick", source) and not found("", source) and not found(None, source) and not found("the dog ... the dog", source)


def test_small_text_functions(spark):
    assert one(spark, text.strip_numbering(F.lit(" 12. Age 18"))) == "Age 18"
    assert tuple(one(spark, text.split_at_marker(F.lit("a b Boilerplate: c"), "Boilerplate:"))) == ("a b", "c")
    assert tuple(one(spark, text.split_at_marker(F.lit("a b"), "Boilerplate:"))) == ("a b", "")
    assert one(spark, text.head_and_tail(F.lit("a b c d e f"), 4)) == "a b ... e f"
    assert [tuple(e) for e in one(spark, text.tagged_events(F.lit("x <visit>one\ntwo <lab> three <other> 4"), ["visit", "lab"]))] == [(1, "visit", "one\ntwo"), (2, "lab", "three <other> 4")]
    assert one(spark, text.strip_fence(F.lit('```json\n{"a": 1}\n```'))) == '{"a": 1}'
    assert one(spark, text.title_codes(F.lit("ABC-1234 with CD123, XY 999 and ABC1234 NCT0123456"))) == ["ABC1234", "XY999"]
    assert one(spark, text.token_f1(F.lit("a a b"), F.lit("A c"))) == pytest.approx(2 * 1 / 5)
    assert one(spark, text.token_f1(F.lit(""), F.lit(""))) == 0.0
    assert one(spark, text.category(F.lit(" white - x"), ["White"], {"White": "White"})) == "White"
    assert one(spark, text.category(F.lit(None).cast("string"), ["White"], {})) == "Unknown"
    assert one(spark, text.mask_digits(F.lit("a12b3"))) == "a#b#"


def test_required_fields(spark):
    whole = "Age Sex Cancer type allowed: Histology Disease state allowed: Prior treatment required: Prior treatment excluded: Biomarker requirements:"
    assert one(spark, text.has_required_fields(F.lit(whole)))
    assert not one(spark, text.has_required_fields(F.lit(whole.replace("Prior treatment excluded:", "")))) and not one(spark, text.has_required_fields(F.lit(None).cast("string")))


def test_complete_criteria(spark):
    make = lambda *x: one(spark, text.complete_criteria(*(F.lit(v).cast("string") for v in x), ["protocol", "ctgov"]))
    assert make("yes", "s", "c", "old", None, None) == "Cohort-specific eligibility criteria:\ns\n\nCommon eligibility criteria:\nc"
    assert make("yes", "s", None, "old", None, None) == "s"
    assert make("no", None, None, "own", "orig", "protocol") == "own" and make("no", None, None, "own", "orig", "llm") == "orig"
    with pytest.raises(Exception, match="cohort-specific"):
        make("yes", " ", "c", "old", None, None)
    with pytest.raises(Exception, match="original"):
        make("no", None, None, "own", "", "llm")


def test_chunks(spark):
    found = one(spark, text.chunks(F.array(*(F.lit(str(i)) for i in range(7))), 4, 1))
    assert [(c["number"], c["start"], c["tokens"]) for c in found] == [(0, 0, ["0", "1", "2", "3"]), (1, 3, ["3", "4", "5", "6"])]
    assert one(spark, text.chunks(F.array().cast("array<string>"), 4, 1)) == []


def test_scores_and_hashes(spark):
    answers = F.create_map(*(F.lit(x) for x in ("reasonableness", "yes", "burden", "yes", "biomarker", "yes")))
    assert one(spark, scores.match_score(answers)) == 4
    assert one(spark, scores.to_unit_range(F.lit(6), 6)) == 1.0
    assert one(spark, scores.sigmoid(scores.logit(F.lit(0.3)))) == pytest.approx(0.3)
    import hashlib

    assert one(spark, hashing.hash_partition(100, "a", F.lit(5))) == int(hashlib.sha256(b"a:5").hexdigest()[:8], 16) % 100
    assert int(one(spark, hashing.pair_hash(F.lit("p"), F.lit("c")))) == int(hashlib.sha256(b"p:c").hexdigest()[:16], 16)
