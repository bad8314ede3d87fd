"""Licences by sentence rules: known sentences get numbers, sequences of numbers are matched against ordered rules."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of licences and notices as they are written, by number, and rules over the numbers.
SENTENCES = {
    1: "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the Software), to deal in the Software without restriction, including without limitation the rights "
    "to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to "
    "whom the Software is furnished to do so, subject to the following conditions:",
    2: "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    3: "The software is provided as is, without warranty of any kind, express or implied, including but not limited to the "
    "warranties of merchantability, fitness for a particular purpose and noninfringement.",
    4: "In no event shall the authors or copyright holders be liable for any claim, damages or other liability, whether in an "
    "action of contract, tort or otherwise, arising from, out of or in connection with the software or the use or other "
    "dealings in the software.",
    10: "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:",
    11: "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    12: "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution.",
    13: "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products "
    "derived from this software without specific prior written permission.",
    20: "Licensed under the Apache License, Version 2.0.",
    21: "Licensed under the Apache License, Version 2.0 (the License);",
    22: "you may not use this file except in compliance with the License.",
    23: "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    24: "SPDX-License-Identifier: Apache-2.0",
    30: "This work is licensed under the GNU General Public License, version 3.",
    31: "This program is free software:",
    32: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
    "Software Foundation, either version 3 of the License, or (at your option) any later version.",
    33: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
    "Software Foundation, either version 2 of the License, or (at your option) any later version.",
    34: "This program is free software;",
    35: "SPDX-License-Identifier: GPL-3.0-only",
    36: "SPDX-License-Identifier: GPL-3.0-or-later",
    37: "SPDX-License-Identifier: GPL-2.0-only",
    40: "Released under the MIT License.",
    41: "Licensed under the MIT License.",
    42: "This project is licensed under the MIT License.",
    43: "SPDX-License-Identifier: MIT",
    50: "Licensed under CC BY-NC 4.0.",
    51: "Licensed under CC BY 4.0.",
    52: "Licensed under CC BY-SA 4.0.",
    53: "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    54: "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    55: "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    60: "This Source Code Form is subject to the terms of the Mozilla Public License, v",  # up to the mark of "v. 2.0"
    61: "SPDX-License-Identifier: MPL-2.0",
    70: "All rights reserved.",
    80: "This is free and unencumbered software released into the public domain.",
    81: "SPDX-License-Identifier: BSD-3-Clause",
    82: "SPDX-License-Identifier: BSD-2-Clause",
    90: "Apache License",
    91: "Version 2.0, January 2004",
    92: "http://www.apache.org/licenses/",
    93: "TERMS AND CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION",
    100: "GNU GENERAL PUBLIC LICENSE",
    101: "Version 2, June 1991",
    102: "Version 3, 29 June 2007",
    103: "GNU LESSER GENERAL PUBLIC LICENSE",
    104: "Version 2.1, February 1999",
    105: "GNU AFFERO GENERAL PUBLIC LICENSE",
    106: "Version 3, 19 November 2007",
    110: "This library is free software;",
    112: "either version 2.1 of the License, or (at your option) any later version.",
    113: "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free "
    "Software Foundation, either version 3 of the License, or (at your option) any later version.",
    114: "you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free "
    "Software Foundation, either version 3 of the License, or (at your option) any later version.",
    115: "you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free "
    "Software Foundation;",
    116: "either version 2 of the License, or (at your option) any later version.",
    117: "you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free "
    "Software Foundation;",
    118: "SPDX-License-Identifier: LGPL-2.1-or-later",
    119: "SPDX-License-Identifier: LGPL-3.0-or-later",
    120: "SPDX-License-Identifier: AGPL-3.0-only",
    121: "SPDX-License-Identifier: AGPL-3.0-or-later",
    122: "SPDX-License-Identifier: GPL-2.0-or-later",
    130: "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.",
    131: "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, "
    "provided that the above copyright notice and this permission notice appear in all copies.",
    132: "THE SOFTWARE IS PROVIDED AS IS AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED "
    "WARRANTIES OF MERCHANTABILITY AND FITNESS.",
    133: "IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
    "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, "
    "ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    134: "SPDX-License-Identifier: ISC",
    140: "Mozilla Public License Version 2.0",
    141: "Mozilla Public License, version 2.0",
    142: "Eclipse Public License - v 2.0",
    143: "Eclipse Public License - v 1.0",
    144: "SPDX-License-Identifier: EPL-2.0",
    145: "SPDX-License-Identifier: EPL-1.0",
    146: "THE ACCOMPANYING PROGRAM IS PROVIDED UNDER THE TERMS OF THIS ECLIPSE PUBLIC LICENSE (AGREEMENT).",
    150: "CC0 1.0 Universal",
    151: "Creative Commons CC0 1.0 Universal",
    152: "SPDX-License-Identifier: CC0-1.0",
}
# A longer rule takes its sentences before a shorter one, and of equal length the one that is written first.
RULES = [
    ("Apache-2.0", [90, 91, 92, 93]), ("Apache-2.0", [90, 91, 92]),
    ("BSD-3-Clause", [70, 10, 11, 12, 13]), ("BSD-like", [70, 10, 11, 12]), ("MIT", [70, 1, 2, 3, 4]),
    ("ISC", [130, 132, 133]), ("ISC", [131, 132, 133]), ("ISC", [70, 130, 132, 133]), ("ISC", [70, 131, 132, 133]), ("ISC", [134]),
    ("GPL-2.0", [100, 101]), ("GPL-3.0", [100, 102]), ("LGPL-3.0", [103, 102]), ("LGPL-2.1", [103, 104]), ("AGPL-3.0", [105, 106]),
    ("LGPL-2.1-or-later", [110, 117, 112]), ("LGPL-3.0-or-later", [31, 113]), ("LGPL-3.0-or-later", [110, 113]),
    ("AGPL-3.0-or-later", [31, 114]), ("GPL-2.0-or-later", [34, 115, 116]), ("GPL-2.0-or-later", [122]),
    ("LGPL-2.1-or-later", [118]), ("LGPL-3.0-or-later", [119]), ("AGPL-3.0-only", [120]), ("AGPL-3.0-or-later", [121]),
    ("MPL-2.0", [140]), ("MPL-2.0", [141]), ("EPL-2.0", [142, 146]), ("EPL-1.0", [143, 146]), ("EPL-2.0", [142]), ("EPL-1.0", [143]),
    ("EPL-2.0", [144]), ("EPL-1.0", [145]), ("CC0-1.0", [150]), ("CC0-1.0", [151]), ("CC0-1.0", [152]),
    ("Apache-2.0", [20]), ("Apache-2.0", [21, 22]), ("Apache-2.0", [24]),
    ("BSD-2-Clause", [82]), ("BSD-3-Clause", [81]), ("BSD-3-Clause", [10, 11, 12, 13]),
    ("BSD-like", [10, 11, 12]),
    ("CC-BY-4.0", [51]), ("CC-BY-4.0", [53]), ("CC-BY-NC-4.0", [50]), ("CC-BY-NC-4.0", [54]), ("CC-BY-SA-4.0", [52]),
    ("CC-BY-SA-4.0", [55]),
    ("GPL-2.0-only", [37]), ("GPL-2.0-or-later", [34, 33]), ("GPL-3.0-only", [30]), ("GPL-3.0-only", [35]),
    ("GPL-3.0-or-later", [31, 32]), ("GPL-3.0-or-later", [36]),
    ("MIT", [1, 2, 3, 4]), ("MIT", [40]), ("MIT", [41]), ("MIT", [42]), ("MIT", [43]),
    ("MPL-2.0", [60]), ("MPL-2.0", [61]), ("Unlicense", [80]), ("proprietary", [70]),
]

#: Where sentences end, and what stands between words.
_END, _BETWEEN = "[.!?;:][ \\t]+", "[^a-z0-9\\n]+"


#: Lines that stand apart from sentences that run over lines: those without words or numbers, and copyright lines (no
#: sentence goes on with such a word and a year, but some do with "copyright notice" and "copyright holder").
_BLANK_LINE = "\\n[^a-z0-9\\n]*(?=\\n)"
_COPYRIGHT_LINE = "(?md)^[^a-z0-9\\n]*(?:copyright(?![ \\t]+(?:notice|holder))|\\(c\\)|\u00a9)[^\\n]*$"


def normalised(sentence: str) -> str:
    """Lower-case words and numbers with one blank between them."""
    return re.sub("[^a-z0-9]+", " ", sentence.lower()).strip()


def _known() -> dict[str, int]:
    return {normalised(told): number for number, told in SENTENCES.items()}


def _ordered() -> list[tuple[str, str]]:
    """The rules, longest first, as text: every sentence of the sequence between commas of its own.

    Two sentences of the same words have one number, also where a rule names the other.
    """
    known = _known()
    same = {number: known[normalised(told)] for number, told in SENTENCES.items()}
    rules = sorted(RULES, key=lambda rule: -len(rule[1]))
    return list({"".join(f",{same[n]}," for n in numbers): name for name, numbers in rules}.items())


def anchors() -> list[str]:
    """Words of which every known sentence has one: the most frequent of those left, until none is left."""
    left, out = [set(s.split()) for s in _known()], []
    while left:
        words = sorted({w for s in left for w in s if len(w) > 5} or {w for s in left for w in s})
        out.append(max(words, key=lambda w: sum(w in s for s in left)))
        left = [s for s in left if out[-1] not in s]
    return out


def _numbers(text: Column) -> Column:
    """The known sentences of a text in their order; ends are line breaks and marks with white space behind them."""
    low = F.regexp_replace(F.lower(text), _END, "\n")
    pieces = F.transform(F.split(F.regexp_replace(low, _BETWEEN, " "), "\n"), lambda s: F.trim(s))
    table = F.create_map(*(F.lit(x) for pair in _known().items() for x in pair))
    return F.filter(F.transform(pieces, lambda s: F.try_element_at(table, s)), lambda n: n.isNotNull())


def _paragraphs(text: Column) -> Column:
    """The known sentences of a text whose sentences run over lines but not over blank lines and copyright lines."""
    lines = F.regexp_replace(F.lower(text), "\r\n?", "\n")
    apart = F.regexp_replace(lines, _COPYRIGHT_LINE, "\n$0\n")
    return _numbers(F.translate(F.regexp_replace(apart, _BLANK_LINE, ". "), "\n", " "))


def recognise(docs: DataFrame, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``sentences`` and ``licenses``, which replace columns of the same names.

    A text is read in three ways: line breaks end sentences; they are blanks; they are blanks but for those that part paragraphs
    or stand around a copyright line, which end sentences. Each way gives the numbers of the known sentences in order, unknown
    ones between them left out. Rules are tried in their order, longest first, and take the sentences that they match, so
    a part of them matches no later rule. ``licenses`` are the sorted names of what matched in any way, but for rules that are a part
    of a longer one that matched; ``sentences`` are those of the first way in which something matched, else of the first. Null and empty texts have none of both. Only Spark's functions
    are used and nothing is shuffled; rows are judged one by one and whole.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    # A text without any of the words that known sentences need is not taken apart.
    low = F.lower(whole)
    some = reduce(lambda a, b: a | b, [low.contains(w) for w in anchors()])
    none, unmatched = F.array().cast("array<int>"), F.array().cast("array<string>")
    # Without line breaks all three ways are the same.
    lines = some & (whole.contains("\n") | whole.contains("\r"))
    ways = F.array(
        F.when(some, _numbers(whole)).otherwise(none),
        F.when(lines, _numbers(F.translate(whole, "\n\r", "  "))).otherwise(none),
        F.when(lines, _paragraphs(whole)).otherwise(none),
    )
    rules = F.array(*(F.lit(rule) for rule, _ in _ordered()))
    named = F.create_map(*(F.lit(x) for pair in _ordered() for x in pair))

    def taken(ids: Column) -> Column:
        start = F.struct(F.concat(F.lit(","), F.array_join(ids, ",,"), F.lit(",")).alias("left"), unmatched.alias("rules"))

        def take(so_far: Column, rule: Column) -> Column:
            left, hits = so_far["left"], so_far["rules"]
            hit = left.contains(rule)
            return F.struct(
                F.when(hit, F.replace(left, rule, F.lit("|"))).otherwise(left).alias("left"),
                F.when(hit, F.concat(hits, F.array(rule))).otherwise(hits).alias("rules"),
            )

        # Most texts have no known sentence: their rules are not tried.
        return F.when(F.size(ids) > 0, F.aggregate(rules, start, take)["rules"]).otherwise(unmatched)

    # Bound once each: else the text would be taken apart anew for each use.
    told = F.transform(F.array(ways), lambda w: F.transform(w, lambda ids: F.struct(ids.alias("ids"), taken(ids).alias("rules"))))[0]

    def names(w: Column) -> Column:
        hits = F.flatten(F.transform(w, lambda x: x["rules"]))
        whole = F.filter(hits, lambda r: ~F.exists(hits, lambda longer: (longer != r) & longer.contains(r)))
        return F.array_sort(F.array_distinct(F.transform(whole, lambda r: named[r])))

    matched = F.transform(
        F.array(told),
        lambda w: F.struct(
            F.coalesce(F.get(F.filter(w, lambda x: F.size(x["rules"]) > 0), F.lit(0))["ids"], F.get(w, F.lit(0))["ids"]).alias("sentences"),
            names(w).alias("licenses"),
        ),
    )
    # Generated rather than projected, which would copy it into both columns.
    kept = [c for c in docs.columns if c not in ("sentences", "licenses")]
    return docs.select(*kept, F.inline(matched))


def oracle_sql(source: str = "SELECT doc_id, text FROM documents") -> str:
    """The query over ``source`` in another engine's SQL."""
    known = ", ".join(f"('{s}', {n})" for s, n in _known().items())
    rules = _ordered()
    steps = ", ".join(f"replace(t{i}, '{rule}', '|') AS t{i + 1}" for i, (rule, _) in enumerate(rules))
    names = ", ".join(f"CASE WHEN t{i} <> t{i + 1} THEN '{rule}' END" for i, (rule, _) in enumerate(rules))
    listed = ", ".join(f"('{rule}', '{name}')" for rule, name in rules)
    return rf"""
WITH docs AS ({source}), known(s, id) AS (VALUES {known}), rules(rule, name) AS (VALUES {listed}),
line AS (
  SELECT doc_id, unnest(list) AS line, generate_subscripts(list, 1) AS place
  FROM (SELECT doc_id, string_split(regexp_replace(lower(coalesce(text, '')), '\r\n?', chr(10), 'g'), chr(10)) AS list FROM docs)),
apart AS (
  SELECT doc_id, string_agg(CASE WHEN NOT regexp_matches(line, '[a-z0-9]') THEN '. '
      WHEN regexp_matches(line, '^[^a-z0-9]*(copyright|\(c\)|©)') AND NOT regexp_matches(line, '^[^a-z0-9]*copyright[ \t]+(notice|holder)')
        THEN '. ' || line || '. ' ELSE line END, ' ' ORDER BY place) AS t
  FROM line GROUP BY doc_id),
texts AS (
  SELECT doc_id, 0 AS way, coalesce(text, '') AS t FROM docs
  UNION ALL SELECT doc_id, 1, translate(coalesce(text, ''), chr(10) || chr(13), '  ') FROM docs
  UNION ALL SELECT doc_id, 2, t FROM apart),
pieces AS (
  SELECT doc_id, way, string_split(regexp_replace(regexp_replace(lower(t), '[.!?;:][ \t]+', chr(10), 'g'), '[^a-z0-9\n]+', ' ', 'g'), chr(10)) AS list
  FROM texts),
numbered AS (SELECT doc_id, way, trim(unnest(list)) AS s, generate_subscripts(list, 1) AS place FROM pieces),
found AS (
  SELECT doc_id, way, string_agg(id::VARCHAR, ',' ORDER BY place) AS ids, string_agg(',' || id || ',', '' ORDER BY place) AS t0, count(*) AS n
  FROM numbered JOIN known USING (s) GROUP BY doc_id, way),
stepped AS (SELECT *, {steps} FROM found),
hit AS (SELECT doc_id, way, ids, n, list_filter([{names}], lambda x: x IS NOT NULL) AS hits FROM stepped),
every AS (SELECT DISTINCT doc_id, unnest(hits) AS rule FROM hit),
named AS (
  SELECT DISTINCT doc_id, name FROM every e JOIN rules USING (rule)
  WHERE NOT EXISTS (SELECT 1 FROM every o WHERE o.doc_id = e.doc_id AND o.rule <> e.rule AND contains(o.rule, e.rule))),
licenses AS (SELECT doc_id, string_agg(name, ',' ORDER BY name) AS licenses FROM named GROUP BY doc_id),
told AS (
  SELECT doc_id, ids, n FROM hit WHERE len(hits) > 0 OR way = 0
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY len(hits) = 0, way) = 1)
SELECT d.doc_id, coalesce(l.licenses, '') AS licenses, coalesce(t.ids, '') AS sentences, coalesce(t.n, 0) AS n_sentences
FROM docs d LEFT JOIN licenses l USING (doc_id) LEFT JOIN told t USING (doc_id)
"""
