"""License scan: lines and whole texts that read like a known licence notice.

DataFrame functions only.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import whole

MIN_DICE = 0.9

# Published licence notices, by their SPDX names; a parameter of the scan.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        "software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ),
    "BSD-3-Clause": (
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Licensed under the 3-Clause BSD License.",
    ),
    "CC-BY-4.0": (
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ),
    "CC-BY-SA-4.0": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    ),
    "GPL-2.0": ("This work is licensed under the GNU General Public License, version 2.",),
    "GPL-3.0": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
        "option) any later version.",
    ),
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction, including without "
        "limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of "
        "the Software, and to permit persons to whom the Software is furnished to do so, subject to the following "
        "conditions: The above copyright notice and this permission notice shall be included in all copies or "
        "substantial portions of the Software.",
    ),
    "MPL-2.0": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
    "NOASSERTION": ("All rights reserved.",),
}


# Whole licences of moderate length, which the SQL does not know; without the copyright line.
FULL_TEXTS: dict[str, tuple[str, ...]] = {
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, "
        "this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the "
        "above copyright notice, this list of conditions and the following disclaimer in the documentation and/or "
        "other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of "
        "its contributors may be used to endorse or promote products derived from this software without specific "
        "prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND "
        "ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY "
        "AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS "
        "BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT "
        "NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
        "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT "
        "(INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
        "THE POSSIBILITY OF SUCH DAMAGE.",
    ),
    "MIT": (
        TEMPLATES["MIT"][2] + " THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
        "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER "
        "LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH "
        "THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    ),
}
ALL_FORMS = {name: texts + FULL_TEXTS.get(name, ()) for name, texts in TEMPLATES.items()}


def normal_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def bigrams(words: Column) -> Column:
    """Distinct pairs of neighbouring words."""
    starts = F.when(F.size(words) > 1, F.sequence(F.lit(0), F.size(words) - 2)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.concat(words[i], F.lit(" "), words[i + 1])))


def template_pairs(text: str) -> list[str]:
    """The same pairs for a template, as literals."""
    words = [w for w in re.split(r"[\W_]+", text.lower()) if w]
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:])))


def size_range(size: int, min_dice: float) -> tuple[float, float]:
    """Sizes that can reach ``min_dice`` beside ``size``: the coefficient is at most 2 * min(a, b) / (a + b)."""
    return size * min_dice / (2 - min_dice), size * (2 - min_dice) / min_dice


def _dice(pairs: Column, template: str, min_dice: float) -> Column:
    """Coefficient with one template; NULL, and nothing compared, outside its size bounds."""
    known = template_pairs(template)
    low, high = size_range(len(known), min_dice)
    common = F.size(F.array_intersect(pairs, F.array(*map(F.lit, known))))
    return F.when(F.size(pairs).between(low, high), 2 * common / (F.size(pairs) + len(known)))


def license_scan(
    docs: DataFrame, templates: Mapping[str, tuple[str, ...]] = ALL_FORMS, min_dice: float = MIN_DICE
) -> DataFrame:
    """doc_id, line, license, dice: each licence whose best template form a line reaches with ``min_dice`` or more.

    Lines are split at line feeds and counted from 0; line -1 stands for the
    whole text of several lines, so a notice that was wrapped is found too. The
    coefficient is 2 * common / (a + b) over distinct pairs of neighbouring
    words, lower-cased, without punctuation. A text is compared only with
    templates whose size bounds its number of pairs fits. One pass over each
    row and no shuffle, so no key can be hot; templates are a parameter, a few
    literals that do not grow with the corpus.

    NULL and empty texts match nothing, templates of fewer than two words
    neither. Each row of the input is scanned for itself, also repeated rows
    and those without doc_id. Other columns play no part.
    """
    forms = {name: [t for t in texts if template_pairs(t)] for name, texts in templates.items()}
    forms = {name: texts for name, texts in forms.items() if texts}
    least = min((size_range(len(template_pairs(t)), min_dice)[0] for texts in forms.values() for t in texts), default=0)
    text = docs.select("doc_id", F.split(whole(F.col("text")), "\n").alias("_lines"))
    units = text.select("doc_id", "_lines", F.posexplode(F.when(
        F.size("_lines") > 1, F.concat("_lines", F.array(F.array_join("_lines", " ")))).otherwise(F.col("_lines"))).alias("_pos", "_unit"))
    line = F.when((F.size("_lines") > 1) & (F.col("_pos") == F.size("_lines")), -1).otherwise(F.col("_pos"))
    worded = units.select("doc_id", line.cast("long").alias("line"), normal_words(F.col("_unit")).alias("_words"))
    paired = worded.filter(F.size("_words") - 1 >= least).select("doc_id", "line", bigrams(F.col("_words")).alias("_pairs"))
    best = [
        F.struct(F.lit(name).alias("license"), _greatest([_dice(F.col("_pairs"), t, min_dice) for t in texts]).alias("dice"))
        for name, texts in forms.items()
    ]
    scored = paired.select("doc_id", "line", F.inline(F.filter(F.array(*best), lambda m: m["dice"] >= min_dice)))
    return scored.select("doc_id", "line", "license", "dice")


def _greatest(scores: list[Column]) -> Column:
    return scores[0] if len(scores) == 1 else F.greatest(*scores)


def _sql() -> str:
    quoted = ", ".join(f"('{n}', '{t.replace(chr(39), chr(39) * 2)}')" for n, texts in TEMPLATES.items() for t in texts)
    pairs = "list_distinct(list_transform(range(1, len({0})), lambda i: {0}[i] || ' ' || {0}[i + 1]))"
    words = "list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '')"
    return f"""
WITH forms AS (SELECT license, {pairs.format('ws')} AS ps FROM (SELECT license, {words.format('t')} AS ws FROM (VALUES {quoted}) AS v(license, t))),
docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
units AS (
  SELECT doc_id, unnest(ls) AS unit, generate_subscripts(ls, 1) - 1 AS line FROM docs
  UNION ALL SELECT doc_id, array_to_string(ls, ' '), -1 FROM docs WHERE len(ls) > 1),
paired AS (SELECT doc_id, line, {pairs.format('ws')} AS ps FROM (SELECT doc_id, line, {words.format('unit')} AS ws FROM units)),
compared AS (
  SELECT doc_id, line, license, 2 * len(list_intersect(u.ps, f.ps)) / (len(u.ps) + len(f.ps)) AS dice FROM paired AS u JOIN forms AS f
  ON 2 * least(len(u.ps), len(f.ps)) >= {MIN_DICE} * (len(u.ps) + len(f.ps)))
SELECT doc_id, line, license, max(dice) AS dice FROM compared WHERE dice >= {MIN_DICE} GROUP BY ALL
"""


SQL = _sql()
