from datetime import date, timedelta
from itertools import product

import pytest
from pyspark.sql import functions as F

from surveil.functions import codes, nulls, rules, text


def one(spark, schema, values, column):
    return spark.createDataFrame([values], schema).select(column.alias("x")).first().x


# ---- null rules ----------------------------------------------------------------------

def test_three_valued_helpers(spark, rows):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "v string")
    out = df.select(
        "v", nulls.is_in("v", ["a"]), nulls.if_else3(F.col("v") == "a", "yes", "no"), text.matches("v", "a|b")
    )
    assert rows(out) == [(None, False, None, False), ("a", True, "yes", True), ("b", False, "no", True)]


def test_numbers(spark):
    schema = "t string, z double, n double"
    row = ("x1", 0.0, 5.0)
    assert one(spark, schema, row, nulls.to_number("t")) is None
    assert one(spark, schema, row, nulls.safe_pct("z", "z")) is None
    assert one(spark, schema, row, nulls.safe_pct("z", "n")) == 0.0
    assert one(spark, schema, row, nulls.null_to_zero("n")) == 5.0
    assert one(spark, schema, row, nulls.sentinel_to_null("t", "Year", "x1")) is None


def test_pct_from_text(spark, rows):
    df = spark.createDataFrame(
        [("0", "0", "0"), ("87.5", "8", "7"), (None, "0", None), ("50", None, None)], "p string, t string, n string"
    )
    assert rows(df.select("t", nulls.pct_from_text("p", "t", "n").alias("r"))) == [
        (None, 0.5), ("0", None), ("0", None), ("8", 0.875),
    ]


# ---- text ----------------------------------------------------------------------------

@pytest.mark.parametrize(
    "value, expected",
    [
        (None, False), ("Negative Influenza A", False), ("NOT DETECTED", False), ("Influenza A", True),
        ("detected", True), ("Victoria lineage", True), ("inconclusive", False),
    ],
)
def test_text_positive(spark, value, expected):
    flag = text.text_positive("v", codes.FLU_TEXT_POSITIVE, codes.FLU_TEXT_NEGATIVE)
    assert one(spark, "v string", (value,), flag) is expected


def test_like_underscore_is_a_wildcard(spark, rows):
    df = spark.createDataFrame([("SARS_CoV-2 Detected",), ("SARS-CoV-2 Detected",), ("sars cov",), (None,)], "v string")
    hits = df.select("v", text.like_any("v", ["SARS_CoV-2 Det%"]).alias("hit"))
    assert rows(hits) == [(None, False), ("SARS-CoV-2 Detected", True), ("SARS_CoV-2 Detected", True), ("sars cov", False)]
    assert one(spark, "v string", ("POS",), text.like_any("v", ["%pos%"])) is True
    assert one(spark, "v string", ("POS",), text.like_any("v", ["%pos%"], ci=False)) is False


def test_comparator(spark):
    for value, intended, written in [("=12 ", True, True), (">16", True, False), ("=10", True, False), ("12", False, False)]:
        assert one(spark, "v string", (value,), text.result_text_comparator("v")) is intended
        assert one(spark, "v string", (value,), text.result_text_comparator("v", as_written=True)) is written


@pytest.mark.parametrize(
    "quarter, n, year, expected",
    [(3, 35.0, 2023, "Q3(n=35)"), (4, 7.0, 2024, "Q4"), (2, 0.0, 2022, "Q2(n=0)"), (3, 1.0, 2024, "Q3(n=1)")],
)
def test_count_label(spark, quarter, n, year, expected):
    row = (quarter, n, year)
    assert one(spark, "q int, n double, y int", row, text.count_label("q", "n", "y", (2024, 3))) == expected


def test_labels_and_keys(spark):
    row = (2022, None, "2023-2")
    schema = "y int, r string, k string"
    label = text.count_label(F.lit(1), F.lit(4), "y", (2024, 3), text.year_label("y"))
    assert one(spark, schema, row, label) == "Q1-'22(n=4)"
    assert one(spark, schema, row, text.composite_key(["r", "y"])) == "NA-2022"
    assert [one(spark, schema, row, c) for c in text.split_parts("k", 3)] == ["2023", "2", None]


# ---- COVID-19 ------------------------------------------------------------------------

STATUSES = ["Confirmed", "Probable", "Suspect", "Not a case", "Contact", None]


def and3(*xs):
    return False if False in xs else None if None in xs else True


def or3(*xs):
    return True if True in xs else None if None in xs else False


def test_classification_equals_the_five_clauses(spark):
    cases = list(product([0, 1, 2], [0, 1, 2], [0, 1, 2], STATUSES))
    df = spark.createDataFrame(cases, "total_rna int, total_ag int, total_ab int, disease_status string")
    for r in df.withColumn("qc", rules.covid_classification_qc()).collect():
        rna, ag, ab, status = r.total_rna, r.total_ag, r.total_ab, r.disease_status
        clause = or3(
            and3(rna >= 1, None if status is None else status == "Confirmed"),
            and3(rna == 0, ag >= 1, ab == 0, status == "Probable"),
            and3(rna == 0, ag >= 1, ab >= 1, status == "Probable"),
            and3(rna == 0, ag == 0, ab >= 1, status in ("Suspect", "Not a case")),
            and3(rna == 0, ag == 0, ab == 0, status in ("Suspect", "Not a case")),
        )
        assert r.qc == {True: "Pass", False: "Fail", None: None}[clause], r


@pytest.mark.parametrize(
    "test, result, value, status, expected",
    [
        (codes.COVID_AG[0], "Inconclusive", "x", "Suspect", "Pass"),
        (codes.COVID_AB[0], "Positive", None, "Probable", "Pass"),
        (codes.COVID_AB[0], "Positive", "x", "Probable", "Fail"),
        (codes.COVID_AG[0], "Inconclusive", "x", "Confirmed", "Fail"),
        (codes.COVID_RNA[0], "Inconclusive", "x", "Suspect", "Fail"),
        (None, None, None, "Contact", "Pass"),
        (None, None, None, None, "Fail"),
    ],
)
def test_inconclusive(spark, test, result, value, status, expected):
    schema = "test string, result string, result_value string, disease_status string"
    assert one(spark, schema, (test, result, value, status), rules.inconclusive_qc()) == expected


def test_covid_indicators_use_their_own_patterns(spark):
    schema = "test string, result string, result_value string"
    for group, value, expected in [
        ("RNA", "result (+)", 1), ("Ag", "result (+)", 1), ("Ab", "result (+)", 0),
        ("RNA", "above threshold", 0), ("Ab", "above threshold", 1), ("Ag", "an antigen", 1), ("RNA", None, 0),
    ]:
        row = (codes.COVID_TESTS[group][0], None, value)
        assert one(spark, schema, row, rules.covid_positive(group)) == expected, (group, value)


# ---- influenza -----------------------------------------------------------------------

def test_flu_case_check_equals_the_written_conditions(spark):
    counts = [0, 1]
    cases = [
        c for c in product(["Confirmed", "Suspect", "Not a case", None], ["Yes", "No", None], counts, counts, counts,
                           counts, ["Home", "Away"], ["Yes", "No"], [None, "Submitted"])
    ]
    schema = ("disease_status string, died string, rna_positives int, culture_positives int, ag_positives int, "
              "ab_positives int, state string, case_closed string, notification_status string")
    as_of = date(2024, 1, 31)
    df = spark.createDataFrame(cases, schema).withColumns(
        {"result": F.lit(None).cast("string"), "result_value": F.lit("x"), "event_date": F.lit(as_of - timedelta(40))}
    )
    out = df.withColumns({"qc": rules.flu_case_qc(as_of), "strict": rules.flu_case_qc(as_of, stale_suspect=True)})
    for r in out.collect():
        s = r.disease_status
        confirmed = None if s is None else s == "Confirmed"
        other = None if s is None else s != "Confirmed"
        rna, cul, ag, ab = r.rna_positives, r.culture_positives, r.ag_positives, r.ab_positives
        any_count = rna >= 0 or cul >= 0
        died = None if r.died is None else r.died == "Yes"
        condition = or3(
            and3(confirmed, died, r.died is not None),
            and3(rna >= 1 or cul >= 1, confirmed),
            and3(any_count, ag >= 1, ab == 0, other),
            and3(any_count, ag == 0, ab >= 1, other),
            and3(any_count, ag >= 1, ab >= 1, other),
            and3(any_count, ag == 0, ab == 0, other),
            and3(r.state != "Home", None if s is None else s == "Not a case"),
            and3(rna >= 1, None if s is None else s == "Suspect", r.case_closed == "No",
                 r.notification_status not in ("Submitted", "Approved")),
        )
        assert r.qc == {True: "Pass", False: "Fail", None: None}[condition], r
        stale = rna >= 1 and s == "Suspect" and r.case_closed == "Yes" and r.notification_status is None
        assert r.strict == ("Fail" if stale else r.qc), r


def test_yamagata_always_fails(spark):
    schema = ("disease_status string, died string, rna_positives int, culture_positives int, result string, "
              "result_value string")
    row = ("Suspect", None, 1, 0, "B yamagata", None)
    assert one(spark, schema, row, rules.flu_case_qc(date(2024, 1, 1))) == "Fail"


def test_test_group_first_list_wins(spark):
    group = rules.test_group("t", {"RNA": ("a",), "Ab": ("a", "b")})
    assert [one(spark, "t string", (t,), group) for t in ("a", "b", "c", None)] == ["RNA", "Ab", "Unknown", "Unknown"]


# ---- flags ---------------------------------------------------------------------------

def test_flags(spark):
    schema = "n bigint, m double, s double, d int"
    assert one(spark, schema, (10, None, None, 7), rules.volume_flag("n", "m", "s", 1)) == "Normal"
    assert one(spark, schema, (2, 4.0, 4.0, 7), rules.volume_flag("n", "m", "s", 1)) == "Normal"
    assert one(spark, schema, (10, 4.0, 4.0, 8), rules.volume_flag("n", "m", "s", 1)) == "Flag"
    assert one(spark, schema, (10, 4.0, 4.0, 8), rules.volume_flag("n", "m", "s", 2)) == "Normal"
    assert one(spark, schema, (10, 4.0, 4.0, 7), rules.silence_flag("d")) == "Normal"
    assert one(spark, schema, (10, 4.0, 4.0, 8), rules.silence_flag("d")) == "Flag"
    assert one(spark, schema, (10, 4.0, 4.0, 9), rules.lag_flag("d", "m")) == "Flag"
    assert one(spark, schema, (10, 4.0, 4.0, 8), rules.lag_flag("d", "m")) == "Normal"


@pytest.mark.parametrize(
    "comment, expected",
    [("Flu A and B positive", True), ("A and B negative", False), ("both, RSV", False), ("Flu A", False), (None, False)],
)
def test_comment_coinfection(spark, comment, expected):
    assert one(spark, "comments string", (comment,), rules.comment_coinfection()) is expected


def test_targets(spark):
    assert one(spark, "p double, t double", (80.0, 80.0), rules.meets_target("p", "t")) is True
    assert one(spark, "p double, t double", (None, 80.0), rules.meets_target("p", "t")) is None
    assert codes.INDICATORS["var6"] == (100, "fraction") and len(codes.INDICATORS) == 11
    assert sorted({t for t, _ in codes.INDICATORS.values()}) == [80, 90, 95, 100]
