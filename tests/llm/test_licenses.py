import textwrap

import pytest

from surveil.llm import licenses

MIT = licenses.TEMPLATES["MIT", "notice"]


def scan(text):
    return licenses.Scanner(licenses.TEMPLATES, 0.05, 0.1).scan(text)


@pytest.mark.parametrize("key", sorted(licenses.TEMPLATES))
def test_each_template_finds_itself(key):
    text = "Some prose before. More of it here\n" + licenses.TEMPLATES[key] + "\nAnd prose after it, unlike any license."
    hit, = scan(text)
    assert (hit["license"], hit["template"], hit["missing"], hit["added"], hit["differences"]) == (*key, 0, 0, "")
    assert licenses.TEMPLATES[key].startswith(text[hit["begin"] : hit["end"]][:20]) and text[hit["begin"] : hit["end"]] in licenses.TEMPLATES[key]


def test_wording_differences():
    changed = MIT.replace("free of charge", "for a charge")
    hit, = scan("x\n" + changed)
    assert (hit["license"], hit["missing"], hit["added"]) == ("MIT", 2, 2)
    assert hit["differences"] == "-free -of +for +a"


def test_unlike_texts_have_none():
    assert scan("A driving license is needed. Copyright law is hard. Permission was granted to the king of the north.") == []
    assert scan("Licensed under CC BY-ND 4.0.") == []
    assert scan("") == []


def test_several_notices_and_long_text():
    filler = "nothing to see here at all. " * 3000
    text = filler + MIT + "\n" + licenses.TEMPLATES["GPL-3.0", "line"] + "\n" + filler + licenses.TEMPLATES["CC-BY-NC-4.0", "line"]
    assert [h["license"] for h in scan(text)] == ["MIT", "GPL-3.0", "CC-BY-NC-4.0"]
    assert [h["license"] for h in scan(("license " * 5000) + MIT)] == ["MIT"]


def test_odd_rows(spark, odd, odd_rows, empty):
    assert licenses.scan_licenses(odd).collect() == [] and licenses.scan_licenses(empty).collect() == []
    rows = [(1, None), (2, "Released under the MIT License."), (2, "Released under the MIT License."), (None, "a\nLicensed under CC BY 4.0.")]
    out = licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["license"], r["begin"]) for r in out) == [("2", "MIT", 0), ("2", "MIT", 0), ("None", "CC-BY-4.0", 2)]


def test_common_licenses_have_templates():
    names = {license for license, _ in licenses.TEMPLATES}
    assert names >= {"All-Rights-Reserved", "BSD-3-Clause", "ISC", "MPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-3.0", "GPL-2.0", "CC0-1.0", "Unlicense"}
    hit, = scan("The end of a tale.\nAll rights reserved.")
    assert (hit["license"], hit["begin"], hit["missing"], hit["added"]) == ("All-Rights-Reserved", 19, 0, 0)


def test_gate_follows_the_templates():
    own = {("House", "line"): "Guests may borrow any volume overnight."}
    hit, = licenses.Scanner(own, 0.05, 0.1).scan("Welcome.\nGuests may borrow any volume overnight.\nThank you.")
    assert (hit["license"], hit["begin"]) == ("House", 9)


@pytest.mark.parametrize("line", ["Released under the MIT License.", "Licensed under CC BY 4.0."])
def test_short_line_in_a_long_block(line):
    names = {t: license for (license, _), t in licenses.TEMPLATES.items()}
    apache = licenses.TEMPLATES["Apache-2.0", "notice"]
    assert [h["license"] for h in scan(apache + "\n" + line)] == ["Apache-2.0", names[line]]
    for n in (60, 100, 300):
        prose = " ".join(f"{w}{i}" for i, w in zip(range(n), "river stone lantern meadow copper window harbour thistle".split() * n))
        assert [h["license"] for h in scan(f"{prose} {line}")] == [names[line]], n


@pytest.mark.parametrize("key", sorted(licenses.TEMPLATES))
def test_wrapped_at_any_width(key):
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.05, 0.1)
    for width in range(12, 121):
        lines = textwrap.wrap(licenses.TEMPLATES[key], width, break_long_words=False, break_on_hyphens=False)
        for mark in ("", "# ", " * "):
            text = "A plain line.\nAnother one of them\n" + "\n".join(mark + line for line in lines) + "\nThe tale begins here\nand goes on.\n"
            got = [(h["license"], h["template"], h["missing"], h["added"]) for h in scanner.scan(text)]
            assert got == [(*key, 0, 0)], (width, mark)


def test_changed_notice_before_an_exact_one():
    changed = MIT.replace("free of charge", "for a charge")
    assert [(h["license"], h["missing"]) for h in scan(changed + "\n" + MIT + "\n" + changed)] == [("MIT", 2), ("MIT", 0), ("MIT", 2)]


def test_exact_line_in_a_block_too_short_to_save_bytes():
    hit, = scan("are onti ouinhe thtiontien on ththhaha erre erin thanly released under the mit license")
    assert (hit["license"], hit["missing"], hit["added"]) == ("MIT", 0, 0)
