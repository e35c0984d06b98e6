"""Codes against literal text, so that a slip in a table cannot hide: the oracle SQL is built from the same tables."""

import pytest

from surveil.functions import codes


@pytest.mark.parametrize(
    "table, size, first, last",
    [
        (codes.COVID_RNA, 41, "2019 Novel Coronavirus E gene [Presence] in Unspecified specimen by NAA with probe detection",
         "SARS-CoV-2 (COVID-19) and SARS-related CoV RNA panel and Influenza virus A and B - Respiratory specimen by NAA with probe detection"),
        (codes.COVID_AG, 5, "SARS-CoV+SARS-CoV-2 Ag Resp Ql IA.rapid", "SARS-CoV-2 Ag Upper resp Ql IA.rapid"),
        (codes.COVID_AB, 22, "SARS coronavirus 2 Ab [Presence] in Serum or Plasma by Immunoassay", "SARS-CoV-2 NAb Titr Ser pVNT"),
        (codes.FLU_RNA, 37, "FLUAV H1 2009 pandemic RNA XXX Ql PCR: ACnc: Pt: XXX: Ord: Prob.amp.tar",
         "Influenza virus A+B RNA  PrThr  Pt  XXX  Ord  Probe.amp.tar"),
        (codes.FLU_CULTURE, 4, "Influenza virus identified: PrId: Pt: xxx: Nom: Shell vial culture",
         "Influenza virus B  PrThr  Pt  XXX  Ord  Organism specific culture"),
        (codes.FLU_AG, 22, "FLUAV Ag Bronch Ql", "Influenza virus B Ag: ACnc: Pt: xxx: Ord:"),
        (codes.FLU_AB, 5, "FLUAV Ab Ser Ql", "FLUBV Ab Titr Ser CF: Titr: Pt: Ser: Qn: Comp fix"),
        (codes.COVID_POSITIVE, 4, "Positive", "Reactive"),
        (codes.FLU_POSITIVE, 13, "Detected", "Reactive"),
        (codes.INCONCLUSIVE, 6, "Inconclusive", "Specimen unsatisfactory for evaluation"),
    ],
)
def test_lists(table, size, first, last):
    assert (len(table), table[0], table[-1]) == (size, first, last)
    assert len(set(table)) == size


def test_middle_entries():
    assert "SARS-CoV-2 (COVID-19) S protein RBD neut ab IA Ql" in codes.COVID_AB
    assert "FLUAV Subtyp XXX PCR: Prid: Pt: XXX: Nom: Probe.amp.tar" in codes.FLU_RNA
    assert "FLUBV RNA  XXX NAA+probe: NCnc: Pt: XXX: Qn: Probe.amp.tar" in codes.FLU_RNA  # two blanks
    assert "SARS-CoV-2 (COVID-19) Ag [Presence] in Upper respiratory specimen by Immunoassay" in codes.COVID_AG


def test_patterns():
    assert codes.COINFECTION_COMMENT == (
        "a and b|a&b|a & b|b&a|b & a|b and a|both|influenza a and|flu a and|influenza b and|flu b and"
    )
    assert codes.COINFECTION_COMMENT_EXCLUDES == "negative|rsv|cov"
    assert codes.COVID_RESULT_LIKE == {"RNA": (), "Ag": ("%antigen%",), "Ab": ()}
    assert codes.COVID_VALUE_LIKE["Ab"] == ("Pos%", "Det%", "%above thresh%", "React%")
    assert codes.CATEGORIES[0] == ("Flu A", "H1", "Influenza A (H1N1)pdm09")
    assert codes.CATEGORIES[-1] == ("Flu B", None, "Influenza B (Lineage Not Determined)")
    assert codes.CATEGORY_UNABLE == "Influenza A (Unable to Subtype)" and codes.CATEGORY_COINFECTION == "Influenza virus co-infection"
