"""Test codes, result codes, text patterns and targets.

These lists are data that the rules must share with the laboratories' own wording, so they
are stated as they are. Every list is short and bounded; rules turn them into ``isin`` or
pattern expressions, which stay inside the scan stage and need no join.
"""

from __future__ import annotations

# ---- COVID-19 tests (fixed values) ---------------------------------------------------

COVID_RNA = (
    "2019 Novel Coronavirus E gene [Presence] in Unspecified specimen by NAA with probe detection",
    "2019 Novel Coronavirus N gene [Presence] in Unspecified specimen by NAA with probe detection",
    "2019 Novel Coronavirus N gene [Presence] in Unspecified specimen by Nucleic acid amplification using primer-probe set N1",
    "2019 Novel Coronavirus N gene [Presence] in Unspecified specimen by Nucleic acid amplification using primer-probe set N2",
    "2019 Novel Coronavirus RdRp gene [Presence] in Unspecified specimen by NAA with probe detection",
    "2019 Novel Coronavirus RNA panel - Unspecified specimen by NAA with probe detection",
    "2019-nCoV RNA XXX NAA+probe-Imp: Imp: Pt: XXX: Ord: Probe.amp.tar",
    "COVID-19 N gene in Saliva by NAA with probe detection",
    "COVID-19 RNA in Saliva by NAA with probe detection",
    "COVID-19 RNA in Saliva by sequencing",
    "FLUABV + SARS-CoV-2 Resp NAA+probe",
    "FLUABV+SARS-CoV-2+RSV Pnl Resp NAA+probe",
    "HCoV 229E RNA Nph Ql NAA+non-probe: PrThr: Pt: Nph: Ord: Non-probe.amp.tar",
    "HCoV HKU1 RNA Nph Ql NAA+non-probe: PrThr: Pt: Nph: Ord: Non-probe.amp.tar",
    "HCoV NL63 RNA Nph Ql NAA+non-probe: PrThr: Pt: Nph: Ord: Non-probe.amp.tar",
    "HCoV OC43 RNA Nph Ql NAA+non-probe: PrThr: Pt: Nph: Ord: Non-probe.amp.tar",
    "Influenza virus A and B and SARS-CoV-2 (COVID-19) RNA panel NAA+probe (Resp)",
    "SARS coronavirus 2 ORF1ab region [Presence] in Respiratory specimen by NAA with probe detection",
    "SARS coronavirus 2 RNA PrThr Pt Nph",
    "SARS coronavirus 2 RNA PrThr Pt Respiratory Ord Probe.amp.tar",
    "SARS coronavirus RNA [Presence] in Unspecified specimen by NAA with probe detection",
    "SARS-CoV-2 (COVID-19) and SARS-related CoV RNA panel and Influenza virus A and B – Respiratory specimen by NAA with probe detectionActive",
    "SARS-CoV-2 (COVID-19) N gene [Presence] in Respiratory specimen by NAA with probe detection",
    "SARS-CoV-2 (COVID-19) RdRp gene NAA+probe (Unsp spec) [ThreshNum]",
    "SARS-CoV-2 (COVID-19) RNA NAA+probe Ql (Nph)",
    "SARS-CoV-2 N gene Nose Ql NAA+non-probe",
    "SARS-CoV-2 N gene Nose Ql NAA+probe",
    "SARS-CoV-2 N gene Nph Ql NAA+probe",
    "SARS-CoV-2 N gene Resp Ql NAA N1",
    "SARS-CoV-2 N gene Resp Ql NAA N2",
    "SARS-CoV-2 N gene Sal Ql NAA N1",
    "SARS-CoV-2 ORF1ab Sal Ql NAA+probe",
    "SARS-CoV-2 RdRp Resp Ql NAA+probe",
    "SARS-CoV-2 RNA Nose Ql NAA+probe",
    "SARS-CoV-2 RNA Resp Ql NAA+non-probe",
    "SARS-CoV-2 RNA Resp Ql NAA+probe",
    "SARS-CoV-2 RNA Resp Ql Seq",
    "SARS-like Coronavirus N gene [Cycle Threshold #] in Unspecified specimen by NAA with probe detection",
    "SARS-like Coronavirus N gene [Presence] in Unspecified specimen by NAA with probe detection",
    "SARS-related CoV RNA NAA+probe Ql (Resp)",
    "SARS-CoV-2 (COVID-19) and SARS-related CoV RNA panel and Influenza virus A and B - Respiratory specimen by NAA with probe detection",
)
# Tallied as RNA, but missing from the original record filter; dropped when as_written.
COVID_RNA_UNLISTED = COVID_RNA[-1]

COVID_AG = (
    "SARS-CoV+SARS-CoV-2 Ag Resp Ql IA.rapid",
    "SARS-CoV-2 (COVID-19) Ag [Presence] in Respiratory specimen by Rapid immunoassay",
    "SARS-CoV-2 (COVID-19) Ag [Presence] in Upper respiratory specimen by Immunoassay",
    "SARS-CoV-2 (COVID-19) Ag panel and Influenza virus A and B - Upper respiratory specimen by Rapid immunoassay",
    "SARS-CoV-2 Ag Upper resp Ql IA.rapid",
)

COVID_AB = (
    "SARS coronavirus 2 Ab [Presence] in Serum or Plasma by Immunoassay",
    "SARS coronavirus 2 Ab PrThr Pt Ser/Plas Ord IA",
    "SARS CORONAVIRUS 2 AB.IGA",
    "SARS coronavirus 2 Ab.IgA PrThr Pt Ser/Plas  Ord IA",
    "SARS CORONAVIRUS 2 AB.IGG",
    "SARS CORONAVIRUS 2 AB.IGM",
    "SARS-CoV IgG Ser Ql IA",
    "SARS-CoV-2 (COVID-19) IgG Ab [Presence] in DBS by Immunoassay",
    "SARS-CoV-2 (COVID-19) S protein RBD neut ab IA Ql",
    "SARS-CoV-2 (COVID-19) specific TCRB gene rearrangements PrThr Pt Bld Ord Sequencing (Ab)",
    "SARS-CoV-2 Ab DBS Ql IA",
    "SARS-CoV-2 Ab Pnl SerPl IA",
    "SARS-CoV-2 Ab Pnl SerPlBld IA.rapid",
    "SARS-CoV-2 Ab SerPl IA-aCnc",
    "SARS-CoV-2 Ab SerPlBld Ql IA.rapid",
    "SARS-CoV-2 Ab SerPl-Imp",
    "SARS-CoV-2 IgG",
    "SARS-CoV-2 IgG + IgM",
    "SARS-CoV-2 IgG SerPl IA-aCnc",
    "SARS-CoV-2 IgM",
    "SARS-CoV-2 IgM SerPl IA-aCnc",
    "SARS-CoV-2 NAb Titr Ser pVNT",
)

COVID_TESTS = {"RNA": COVID_RNA, "Ag": COVID_AG, "Ab": COVID_AB}

# ---- COVID-19 results (fixed values) -------------------------------------------------

COVID_POSITIVE = ("Positive", "Detected", "Above Threshold", "Reactive")

# Per test group: LIKE patterns on RESULT, and on RESULT_VALUE.
COVID_RESULT_LIKE = {"RNA": (), "Ag": ("%antigen%",), "Ab": ()}
COVID_VALUE_LIKE = {
    "RNA": ("%pos%", "Det%", "COVID det%", "SARS_CoV-2 Det%", "SARS-CoV-2 Det%", "%(+)%"),
    "Ag": (
        "%pos%", "%above thresh%", "React%", "Det%", "COVID det%", "SARS_CoV-2 Det%",
        "SARS-CoV-2 Det%", "%(+)%", "%antigen%",
    ),
    "Ab": ("Pos%", "Det%", "%above thresh%", "React%"),
}

INCONCLUSIVE = (
    "Inconclusive", "Indeterminate", "Invalid", "Equivocal", "No RNA detected",
    "Specimen unsatisfactory for evaluation",
)

# ---- Influenza tests (fixed values) --------------------------------------------------

FLU_RNA = (
    "FLUAV H1 2009 pandemic RNA XXX Ql PCR: ACnc: Pt: XXX: Ord: Prob.amp.tar",
    "FLUAV H1 HA gene Nph Ql NAA+probe",
    "FLUAV H1 RNA XXX Ql PCR: ACnc: Pt: XXX: Ord: Probe.amp.tar",
    "FLUAV H3 RNA Nph Ql NAA+probe",
    "FLUAV H3 RNA Upper resp Ql NAA+probe",
    "FLUAV RNA Lower resp Ql NAA+non-probe",
    "FLUAV RNA XXX QL NAA+probe",
    "FLUAV Subtyp XXX PCR: Prid: Pt: XXX: Nom: Probe.amp.tar",
    "FLUBV NS gene Nph Ql NAA+probe",
    "FLUBV RNA  XXX NAA+probe: NCnc: Pt: XXX: Qn: Probe.amp.tar",
    "FLUBV RNA Lower resp Ql NAA+non-probe",
    "FLUBV RNA XXX Ql PCR: ACnc: Pt: XXX: Ord: Probe.amp.tar",
    "Influenza virus A H1 2009 pandemic RNA  PrThr  Pt  Nph  Ord  Non-probe.amp.tar",
    "Influenza virus A H1 2009 pandemic RNA panel - Unspecified specimen by NAA with probe detection",
    "Influenza virus A H1 RNA  PrThr  Pt  Nph  Ord  Non-probe.amp.tar",
    "Influenza virus A H1 RNA  PrThr  Pt  Nph  Ord  Probe.amp.tar",
    "Influenza virus A H3 HA gene  PrThr  Pt  Nph  Ord  Probe.amp.tar",
    "Influenza virus A H3 RNA  PrThr  Pt  Nph  Ord  Non-probe.amp.tar",
    "Influenza virus A H3 RNA  PrThr  Pt  XXX  Ord  Probe.amp.tar",
    "Influenza virus A M gene  PrThr  Pt  Nph  Ord  Probe.amp.tar",
    "Influenza virus A RNA  PrThr  Pt  Nph  Ord  Non-probe.amp.tar",
    "Influenza virus A RNA  PrThr  Pt  Nph  Ord  Probe.amp.tar",
    "Influenza virus A RNA [Presence] in Respiratory specimen by NAA with probe detection",
    "Influenza virus A RNA [Presence] in Upper respiratory specimen by NAA with probe detection",
    "Influenza virus A RNA: ACnc: Pt: xxx: Ord: Probe.Amp.Tar",
    "Influenza virus A swine origin RNA  Prid  Pt  XXX  Nom  Probe.amp.tar",
    "Influenza virus B lineage RNA  Prid  Pt  XXX  Nom  Probe.amp.tar",
    "Influenza virus B RNA  PrThr  Pt  Nph  Ord  Non-probe.amp.tar",
    "Influenza virus B RNA [Presence] in Respiratory specimen by NAA with probe detection",
    "Influenza virus B RNA [Presence] in Upper respiratory specimen by NAA with probe detection",
    "Influenza virus B RNA PrThr Pt Nph Ord Probe.amp.tar",
    "FLUABV + SARS-CoV-2 Resp NAA+probe",
    "FLUABV+SARS-CoV-2+RSV Pnl Resp NAA+probe",
    "FLUAV+FLUBV RNA XXX PCR: Prid: Pt: XXX: Nom: Probe.amp.tar",
    "FLUAV+FLUBV+RSV RNA pnl Up resp NAA+pr",
    "Influenza virus A and B and SARS-CoV-2 (COVID-19) RNA panel NAA+probe (Resp)",
    "Influenza virus A+B RNA  PrThr  Pt  XXX  Ord  Probe.amp.tar",
)

FLU_CULTURE = (
    "Influenza virus identified: PrId: Pt: xxx: Nom: Shell vial culture",
    "FLUAV XXX Ql Cult: ACnc: Pt: XXX: Ord: Organism specific culture",
    "FLUV XXX Cult: ACnc: Pt: XXX: Nom: Organism specific culture",
    "Influenza virus B  PrThr  Pt  XXX  Ord  Organism specific culture",
)

FLU_AB = (
    "FLUAV Ab Ser Ql",
    "FLUAV Ab Titr Ser CF: Titr: Pt: Ser: Qn: Comp fix",
    "FLUAV IgG Ser Ql",
    "FLUBV Ab Fld Ql",
    "FLUBV Ab Titr Ser CF: Titr: Pt: Ser: Qn: Comp fix",
)

FLU_AG = (
    "FLUAV Ag Bronch Ql",
    "FLUAV Ag Nose Ql",
    "FLUAV Ag Nph Ql IA",
    "FLUAV Ag Spec Ql IA",
    "FLUAV Ag Upper resp Ql IA.rapid",
    "FLUAV and FLUBV Ag Nose EIA.rapid Prid: Pt: Node: Nom: EIA.rapid",
    "FLUAV+FLUBV Ag Nose Ql IA.rapid",
    "FLUAV+FLUBV Ag XXX Ql IF: ACnc: Pt: XXX: Ord: IF",
    "FLUBV Ag Spec Ql IA",
    "FLUBV Ag Throat Ql",
    "FLUBV Ag Throat Ql IF",
    "FLUBV Ag Upper resp Ql IA.rapid",
    "FLUBV Ag Nph Ql",
    "Influenza virus A Ag  PrThr  Pt  Thrt  Ord",
    "Influenza virus A Ag  PrThr  Pt  XXX  Ord  IF",
    "Influenza virus A Ag [Presence] in Nose by Immunoassay",
    "Influenza virus A Ag: ACnc: Pt: xxx: Ord:",
    "Influenza virus A+B Ag: ACnc: Pt: xxx: Ord:",
    "Influenza virus A+B+C Ag  PrThr  Pt  XXX  Ord",
    "Influenza virus B Ag  PrThr  Pt  Nose  Ord",
    "Influenza virus B Ag  PrThr  Pt  Nph  Ord  IA",
    "Influenza virus B Ag: ACnc: Pt: xxx: Ord:",
)

# In the order in which a test is labelled: first group that lists it wins.
FLU_TESTS = {"RNA": FLU_RNA, "Culture": FLU_CULTURE, "Ab": FLU_AB, "Ag": FLU_AG}

# ---- Influenza results (fixed values) ------------------------------------------------

FLU_POSITIVE = (
    "Detected",
    "Influenza A",
    "Influenza A virus",
    "Influenza A virus (organism)",
    "Influenza A virus subtype H1 2009 pandemic",
    "Influenza A virus subtype H3",
    "Influenza B",
    "Influenza B virus",
    "Influenza B virus Victoria lineage",
    "Flu A",
    "Flu B",
    "Positive",
    "Reactive",
)

FLU_TEXT_POSITIVE = (
    "detect|pos|lineage|H1|H3|Influenza A|Influenza A virus|Influenza B|Influenza B virus|Flu A|Flu B"
)
FLU_TEXT_NEGATIVE = "not|neg"

# ---- Influenza type, subtype, category (fixed values) --------------------------------

# Tests for one target only; a name that also matches the panel pattern is no such test.
SINGLE_TARGET = {
    "Flu A": r"\s*Influenza virus A\s*|\s*FLUAV\s*",
    "Flu B": r"\s*Influenza virus B\s*|\s*FLUBV\s*",
}
SINGLE_TARGET_EXCLUDES = r" and |V\+F|A\+B|V\+SARS|V \+ SARS"

TYPE_IN_COMMENTS = {
    "Flu A": "Influenza A positive|Flu A positive|Flu A|Influenza A|Positive A|Positive flu A|Positive for flu A|Positive A virus",
    "Flu B": "Influenza B positive|Flu B positive|Flu B|Influenza B|Positive B|Positive flu B|Positive for flu B|Positive B virus",
}

# Combined panels. The written form also finds "and" inside "pandemic".
PANEL_AS_WRITTEN = r"\s*and\s*|V\+F|A\+B|V\s*\+\s*SARS|\s*FLUV\s*"
PANEL_INTENDED = r"\band\b|V\+F|A\+B|V\s*\+\s*SARS|\s*FLUV\s*"
PANEL_RESULT = {"Flu A": r"Influenza\s*A", "Flu B": r"Influenza\s*B"}
PANEL_VALUE = {
    "Flu A": r"Influenza\s*A|Flu A|\s*H1\s*2009|\s*H1-2009|\s*H1\s*(2009)\s*|\s*FLUAV\s*",
    "Flu B": r"Influenza\s*B|Flu\s*B|\s*FLUBV\s*",
}
PANEL_DESCRIPTION = {
    "Flu A": r"Influenza\s*A|Flu A|H1\s*2009|H1-2009|H1\s*(2009)\s*|\s*FLUAV\s*",
    "Flu B": r"Influenza\s*B|Flu\s*B|\s*FLUBV\s*",
}

# (subtype, pattern, columns searched), first match wins.
SUBTYPES = (
    ("H3", "H3", ("test", "result", "result_value", "local_description")),
    ("H1 prior to 2010", "H1 prior to 2010", ("result", "result_value", "local_description")),
    ("H1 2009", "H1 2009|H1-2009", ("test", "result", "result_value", "local_description")),
    ("H1", "H1", ("test",)),
    ("H1N1 pdm09", "H1N1 pdm09", ("result", "result_value", "local_description")),
    ("H2N2v", "H2N2v", ("result", "result_value", "local_description")),
    ("Victoria", "Victoria", ("result", "result_value", "local_description")),
    ("Yamagata", "Yamagata", ("result", "result_value", "local_description")),
)
UNABLE_TO_SUBTYPE = "Unable to Subtype"

# (type, subtype, category); None as subtype means no subtype.
CATEGORIES = (
    ("Flu A", "H1", "Influenza A (H1N1)pdm09"),
    ("Flu A", "H1 2009", "Influenza A (H1N1)pdm09"),
    ("Flu A", "H3", "Influenza A (H3)"),
    ("Flu A", None, "Influenza A (Subtyping Not Done)"),
    ("Flu B", "Victoria", "Influenza B/Victoria lineage"),
    ("Flu B", None, "Influenza B (Lineage Not Determined)"),
)
CATEGORY_UNABLE = "Influenza A (Unable to Subtype)"
CATEGORY_COINFECTION = "Influenza virus co-infection"

COINFECTION_COMMENT = (
    "a and b|a&b|a & b|b&a|b & a|b and a|both|influenza a and|flu a and|influenza b and|flu b and"
)
COINFECTION_COMMENT_EXCLUDES = "negative|rsv|cov"

# ---- indicator targets in percent (fixed values) -------------------------------------

INDICATORS = {
    "var1": (80, "fraction"), "var2": (80, "fraction"), "var3": (80, "fraction"), "var4": (80, "fraction"),
    "var5": (80, "fraction"), "var6": (100, "fraction"), "var7": (80, "fraction"), "var8": (90, "percent"),
    "var9": (90, "percent"), "pct_CDC": (95, "percent"), "pct_class_correct": (80, "fraction"),
}


def known_tests(groups: dict[str, tuple[str, ...]]) -> list[str]:
    return [code for codes in groups.values() for code in codes]
