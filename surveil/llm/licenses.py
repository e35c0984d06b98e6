"""License scan by conditional compression: which template, as a raw dictionary, shortens a block most."""

from __future__ import annotations

import difflib
import re
from collections import Counter
from collections.abc import Iterator, Mapping, Set

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The wording of license notices, (license, variant) -> text.
TEMPLATES: dict[tuple[str, str], str] = {
    ("AGPL-3.0", "line"): "This work is licensed under the GNU Affero General Public License, version 3.",
    ("AGPL-3.0", "notice"): (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    ("All-Rights-Reserved", "line"): "All rights reserved.",
    ("Apache-2.0", "line"): "Licensed under the Apache License, Version 2.0.",
    ("Apache-2.0", "notice"): (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
        "or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License."
    ),
    ("BSD-2-Clause", "notice"): (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution."
    ),
    ("BSD-3-Clause", "line"): "Licensed under the BSD 3-Clause License.",
    ("BSD-3-Clause", "notice"): (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
        "the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the "
        "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without "
        "specific prior written permission."
    ),
    ("CC-BY-4.0", "line"): "Licensed under CC BY 4.0.",
    ("CC-BY-4.0", "notice"): "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ("CC-BY-NC-4.0", "line"): "Licensed under CC BY-NC 4.0.",
    ("CC-BY-NC-4.0", "notice"): "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ("CC-BY-SA-4.0", "line"): "Licensed under CC BY-SA 4.0.",
    ("CC-BY-SA-4.0", "notice"): "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ("CC0-1.0", "line"): "Licensed under CC0 1.0.",
    ("CC0-1.0", "notice"): "This work is licensed under a Creative Commons Zero v1.0 Universal License.",
    ("CC0-1.0", "waiver"): "has waived all copyright and related or neighboring rights to this work.",
    ("GPL-2.0", "line"): "This work is licensed under the GNU General Public License, version 2.",
    ("GPL-2.0", "notice"): (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    ),
    ("GPL-3.0", "line"): "This work is licensed under the GNU General Public License, version 3.",
    ("GPL-3.0", "notice"): (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    ("ISC", "line"): "Released under the ISC License.",
    ("ISC", "notice"): (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided "
        "that the above copyright notice and this permission notice appear in all copies."
    ),
    ("LGPL-2.1", "line"): "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    ("LGPL-2.1", "notice"): (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."
    ),
    ("LGPL-3.0", "line"): "This work is licensed under the GNU Lesser General Public License, version 3.",
    ("LGPL-3.0", "notice"): (
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License "
        "as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."
    ),
    ("MIT", "line"): "Released under the MIT License.",
    ("MIT", "notice"): (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files "
        "(the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, "
        "merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is "
        "furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software."
    ),
    ("MPL-2.0", "line"): "Licensed under the Mozilla Public License, version 2.0.",
    ("MPL-2.0", "notice"): (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with "
        "this file, You can obtain one at http://mozilla.org/MPL/2.0/."
    ),
    ("Unlicense", "line"): "Released under the Unlicense.",
    ("Unlicense", "notice"): (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means."
    ),
}

WORD = re.compile(r"[^\W_]+(?:\.\d+)*")
LEVEL = 9


def words_of(text: str) -> list[str]:
    return [w.lower() for w in WORD.findall(text)]


def cues(words: list[str], most_changed: float) -> set[str]:
    """The longest words of a template that together occur in it more often than words may be missing, so a notice holds one of them."""
    out: set[str] = set()
    left = int(most_changed * len(words)) + 1
    for word, n in sorted(Counter(words).items(), key=lambda w: (-len(w[0]), w[0])):
        if left <= 0:
            break
        out.add(word)
        left -= n
    return out


def blocks(words: list[str], reach: int, cue: Set[str]) -> list[tuple[int, int]]:
    """Candidate blocks (first word, last word) for notices of at most ``reach`` words: whatever lies so near to a word of ``cue``.

    Line feeds and sentence ends play no part, so it does not matter how a notice is wrapped. Blocks that
    meet are one. A block longer than twice ``reach`` is cut into windows of that many words, each beginning
    ``reach`` words after the one before, so whatever is as long as a notice lies whole in one.
    """
    runs: list[list[int]] = []
    for i, word in enumerate(words):
        if word in cue:
            if runs and i - reach < runs[-1][1]:
                runs[-1][1] = min(len(words), i + reach)
            else:
                runs.append([max(0, i - reach), min(len(words), i + reach)])
    return [(at, min(b, at + 2 * reach)) for a, b in runs for at in range(a, max(a + 1, b - reach), reach)]


def _joined(words: list[str]) -> bytes:
    """The words with one space between, so that neither line feeds nor comment marks keep a match from going on."""
    return " ".join(words).encode("utf-8", "surrogatepass")


class Scanner:
    """Templates as raw dictionaries."""

    def __init__(self, templates: Mapping[tuple[str, str], str], least_gain: float, most_changed: float):
        import zstandard

        def compressor(dictionary=None):
            params = zstandard.ZstdCompressionParameters.from_level(LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False)
            return zstandard.ZstdCompressor(compression_params=params, dict_data=dictionary)

        def raw(words: list[str]):
            return zstandard.ZstdCompressionDict(_joined(words), dict_type=zstandard.DICT_TYPE_RAWCONTENT)

        self.words = {k: words_of(t) for k, t in templates.items()}
        self.plain = compressor()
        self.with_template = {k: compressor(raw(w)) for k, w in self.words.items()}
        self.own = {k: len(self.plain.compress(_joined(w))) for k, w in self.words.items()}
        self.reach = int(max(map(len, self.words.values()), default=0) * (1 + most_changed)) + 1  # words of a notice, at most
        self.cue = set().union(*[cues(w, most_changed) for w in self.words.values()])
        self.counts = {k: Counter(w) for k, w in self.words.items()}
        self.least_gain, self.most_changed = least_gain, most_changed

    def rank(self, block: list[str]) -> list[tuple[float, tuple[str, str]]]:
        """(saved bytes as a share of the bytes that the template could save, its own compressed size; template), best first."""
        raw = _joined(block)
        alone = len(self.plain.compress(raw))
        gains = (((alone - len(c.compress(raw))) / self.own[k], k) for k, c in self.with_template.items())
        return sorted(gains, key=lambda g: (-g[0], g[1]))

    def possible(self, key: tuple[str, str], has: Counter) -> bool:
        """Whether a block with so many of each word holds enough of the template's words, wherever they are."""
        wanted = self.counts[key]
        return sum(n - min(n, has[w]) for w, n in wanted.items()) <= self.most_changed * len(self.words[key])

    def notices(self, key: tuple[str, str], words: list[str]) -> Iterator[tuple[int, int, int, int, str]]:
        """All wordings of a template: the best, then those before and after it."""
        todo = [(0, len(words))]
        while todo:
            begin, end = todo.pop()
            if end > begin and self.possible(key, Counter(words[begin:end])) and (w := self.wording(key, words[begin:end])):
                yield begin + w[0], begin + w[1], *w[2:]
                todo += [(begin, begin + w[0]), (begin + w[1], end)]

    def wording(self, key: tuple[str, str], words: list[str]) -> tuple[int, int, int, int, str] | None:
        """(first word, last word, missing, added, differences) of the template in the block, if near enough."""
        wanted = self.words[key]
        found = [m for m in difflib.SequenceMatcher(None, wanted, words, autojunk=False).get_matching_blocks() if m.size]
        found = _dense(found, len(wanted))
        if not found:
            return None
        first, last = found[0].b, found[-1].b + found[-1].size
        ops = difflib.SequenceMatcher(None, wanted, words[first:last], autojunk=False).get_opcodes()
        gone = [w for tag, a, b, _, _ in ops if tag in ("delete", "replace") for w in wanted[a:b]]
        new = [w for tag, _, _, a, b in ops if tag in ("insert", "replace") for w in words[first:last][a:b]]
        if len(gone) + len(new) > self.most_changed * len(wanted):
            return None
        return first, last, len(gone), len(new), " ".join([*[f"-{w}" for w in gone], *[f"+{w}" for w in new]])

    def scan(self, text: str) -> list[dict]:
        """Confirmed notices: the ranking proposes, the wording decides; of overlapping ones the longest and best stays."""
        if self.cue.isdisjoint(words_of(text)):
            return []
        spans = [(m.start(), m.end()) for m in WORD.finditer(text)]
        words = [text[a:b].lower() for a, b in spans]
        proposed = []
        for begin, end in blocks(words, self.reach, self.cue):
            has = Counter(words[begin:end])
            wanted = {k for k in self.words if self.possible(k, has)}
            if not wanted:  # nothing could be confirmed
                continue
            for place, (gain, key) in enumerate(self.rank(words[begin:end]), 1):
                for first, last, missing, added, differences in self.notices(key, words[begin:end]) if key in wanted else ():
                    span, changed = (spans[begin + first][0], spans[begin + last - 1][1]), missing + added
                    if gain < self.least_gain and changed:  # a few bytes are little to go by, but an exact wording is one
                        continue
                    proposed.append((changed - len(self.words[key]), changed, place, -gain, key, span, missing, added, differences))
        taken: list[tuple[int, int]] = []
        hits = []
        for _, _, place, gain, key, (first, last), missing, added, differences in sorted(proposed):
            if any(first < b and a < last for a, b in taken):
                continue
            taken.append((first, last))
            hits.append({
                "begin": first, "end": last, "license": key[0], "template": key[1], "place": place, "reduction": -gain,
                "missing": missing, "added": added, "differences": differences,
            })
        return sorted(hits, key=lambda h: h["begin"])


def _dense(found: list, size: int) -> list:
    """The run of matches that holds most words within about the template's length, so that stray words far off don't count."""
    best, best_words = [], 0
    for i in range(len(found)):
        run, words = [], 0
        for m in found[i:]:
            if m.b + m.size - found[i].b > size + max(2, size // 5):
                break
            run.append(m)
            words += m.size
        if words > best_words:
            best, best_words = run, words
    return best


HITS = "key {key}, begin long, end long, license string, template string, place int, reduction double, missing int, added int, differences string"


def scan_licenses(
    docs: DataFrame, templates: Mapping[tuple[str, str], str] | None = None, key: str = "doc_id", text: str = "text",
    least_gain: float = 0.05, most_changed: float = 0.1,
) -> DataFrame:
    """One row per license notice in a text: key, begin and end (code points), license, template and how it compares.

    Blocks are the words as far from the templates' cues as the longest notice reaches, however it is
    wrapped; each block that holds enough words of one is compressed alone and with every template as a raw
    dictionary. Templates that save ``least_gain`` or more of their own compressed size, however
    long the block, are ranked by that share (``place``, ``reduction``) and confirmed word by word: notices with more
    changed words than ``most_changed`` of the template are none. Exact wordings are notices whatever they save.
    ``missing`` and ``added`` count the changed words, ``differences`` lists them; exact notices have none.

    Null and empty texts have no notices. Repeated rows are scanned each. Ties are settled by the
    template's name. Texts stream; nothing is shuffled. Other columns are not read.
    """
    templates = dict(TEMPLATES if templates is None else templates)
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(templates, least_gain, most_changed)
        fields = [
            ("begin", pa.int64()), ("end", pa.int64()), ("license", pa.string()), ("template", pa.string()), ("place", pa.int32()),
            ("reduction", pa.float64()), ("missing", pa.int32()), ("added", pa.int32()), ("differences", pa.string()),
        ]
        for batch in batches:
            at, hits = [], []
            for i, value in enumerate(batch.column(1)):
                for hit in scanner.scan(value.as_py() or ""):
                    at.append(i)
                    hits.append(hit)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), *[pa.array([h[n] for h in hits], t) for n, t in fields]],
                names=["key", *[n for n, _ in fields]],
            )

    return docs.select(F.col(key), F.col(text)).mapInArrow(run, HITS.format(key=kind)).withColumnRenamed("key", key)
