import pytest

from surveil.functions import codes, typing

SCHEMA = "test string, result string, result_value string, local_description string, comments string"
PANEL = "FLUAV+FLUBV RNA XXX PCR: Prid: Pt: XXX: Nom: Probe.amp.tar"


def typed(spark, *row, **options):
    df = spark.createDataFrame([row], SCHEMA)
    df = df.select(typing.flu_type(**options).alias("flu_type"), typing.flu_subtype().alias("subtype"))
    return df.first()


@pytest.mark.parametrize(
    "row, expected",
    [
        (("FLUAV RNA XXX QL NAA+probe", None, None, None, None), "Flu A"),
        (("FLUBV NS gene Nph Ql NAA+probe", None, None, None, None), "Flu B"),
        ((PANEL, "Influenza B", None, None, None), "Flu B"),
        ((PANEL, "Influenza B", "Flu A", None, None), "Flu A"),
        (("other test", None, "Flu B", None, None), "Flu B"),
        (("other test", None, None, "influenza b", None), "Flu B"),
        ((PANEL, "Detected", None, None, "Positive B"), "Flu B"),
        ((PANEL, "Detected", None, None, None), "Unknown"),
        (("Influenza virus A and B and SARS-CoV-2 (COVID-19) RNA panel NAA+probe (Resp)", "Influenza A", None, None, None), "Flu A"),
        ((None, None, None, None, None), "Unknown"),
    ],
)
def test_type(spark, row, expected):
    assert typed(spark, *row).flu_type == expected


def test_and_inside_pandemic(spark):
    row = ("H1 2009 pandemic assay", "Influenza A", None, None, None)
    assert typed(spark, *row).flu_type == "Flu A"
    assert typed(spark, *row, as_written=False).flu_type == "Unknown"


@pytest.mark.parametrize(
    "row, expected",
    [
        (("x", "H3", "H1 2009", None, None), "H3"),
        (("x", "H1 prior to 2010", None, None, None), "H1 prior to 2010"),
        (("FLUAV H1 RNA", None, None, None, None), "H1"),
        (("FLUAV H1 2009 RNA", None, None, None, None), "H1 2009"),
        (("x", None, "B Victoria", "Yamagata", None), "Victoria"),
        (("x", "unable to subtype", None, "invalid", None), "Unable to Subtype"),
        (("x", None, None, "unable", None), "Unable to Subtype"),
        (("x", None, None, "unable, invalid", None), None),
        ((None, None, None, None, None), None),
    ],
)
def test_subtype(spark, row, expected):
    assert typed(spark, *row).subtype == expected


@pytest.mark.parametrize(
    "kind, subtype, expected, as_written",
    [
        ("Flu A", None, "Influenza A (Subtyping Not Done)", None),
        ("Flu A", "H1", "Influenza A (H1N1)pdm09", None),
        ("Flu A", "H1N1 pdm09", None, None),
        ("Flu B", "Yamagata", None, None),
        ("Flu B", None, "Influenza B (Lineage Not Determined)", None),
        ("Unknown", "H3", "Unknown", "Unknown"),
        ("Coinfection", "H3", codes.CATEGORY_COINFECTION, codes.CATEGORY_COINFECTION),
        ("Flu A", "Unable to Subtype", codes.CATEGORY_UNABLE, codes.CATEGORY_UNABLE),
        ("Flu B", "Unable to Subtype", None, codes.CATEGORY_UNABLE),
    ],
)
def test_category(spark, kind, subtype, expected, as_written):
    df = spark.createDataFrame([(kind, subtype)], "flu_type string, subtype string")
    row = df.select(typing.report_category().alias("a"), typing.report_category(as_written=True).alias("b")).first()
    assert row.a == expected
    assert row.b == (as_written if as_written else expected)
