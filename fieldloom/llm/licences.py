"""Licence scans: units of a text against licence templates by the Dice coefficient over word bigrams."""

from __future__ import annotations

import math
import re
from collections import Counter
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialise

#: Words of a licence text, after lower-casing.
LICENCE_WORD = r"[\p{L}\p{N}]+"

#: Well-known notices and short licence texts.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.",
    ],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-4.0": ["This work is licensed under the Creative Commons Attribution 4.0 International License."],
    "CC-BY-SA-4.0": ["This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["To the extent possible under law, the author(s) have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide. This software is distributed without any warranty."],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."],
    "AGPL-3.0": ["This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."],
    "LGPL-2.1": ["This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."],
    "GPL-2.0": ["This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    ],
    "ISC": ["Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."],
    "BSD-2-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."],
    "BSD-3-Clause": ["Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."],
    "Unlicense": ["This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
}


def _bigrams(text: str) -> list[str]:
    words = re.findall(r"[^\W_]+", text.lower().replace("licence", "license"))
    return [f"{a} {b}" for a, b in zip(words, words[1:])]


def template_rows(templates: dict[str, list[str]], least: float) -> list[tuple]:
    """(licence, number, size, low, high, bigram, count): a text of n bigrams can reach the coefficient only if low <= n <= high, and shares at least `low` of them."""
    out = []
    for licence in sorted(templates):
        for number, text in enumerate(templates[licence]):
            counts = Counter(_bigrams(text))
            size = sum(counts.values())
            low, high = math.ceil(size * least / (2 - least)), math.floor(size * (2 - least) / least)
            out += [(licence, number, size, low, high, bigram, count) for bigram, count in sorted(counts.items())]
    return out


def anchor_words(rows: list[tuple]) -> list[str]:
    """Words of which any text that reaches the coefficient holds at least one: without the bigrams of a template that hold one, fewer than `low` are left.

    Words of six letters and more are taken first, as they are rare in other texts, and of these the ones that serve most templates.
    """
    lacking = {}
    for r in rows:
        lacking.setdefault(r[:5], {})[r[5]] = r[6]
    chosen = []
    while any(sum(left.values()) >= key[3] for key, left in lacking.items()):
        gains: Counter = Counter()
        for key, left in lacking.items():
            need, own = sum(left.values()) - key[3] + 1, Counter()
            if need > 0:
                for bigram, n in left.items():
                    for w in set(bigram.split()):
                        own[w] += n
                gains.update({w: min(n, need) / need for w, n in own.items()})
        best = max(gains, key=lambda w: (min(len(w), 6), gains[w], w))
        chosen.append(best)
        lacking = {key: {bigram: n for bigram, n in left.items() if best not in bigram.split()} for key, left in lacking.items()}
    return chosen


def _spelled(text: Column) -> Column:
    return F.replace(F.lower(text), F.lit("licence"), F.lit("license"))


def _words(text: Column) -> Column:
    return F.regexp_extract_all(_spelled(text), F.lit(LICENCE_WORD), F.lit(0))


def licence_scan(docs: DataFrame, templates: dict[str, list[str]] | None = None, least: float = 0.8) -> DataFrame:
    """(doc_id, unit, position, licence, dice) for each unit of a text that is at least `least` like a template.

    Units are the lines, the blocks between blank lines (of texts that have blank lines), the whole text (of several lines) and
    passages. A passage is any run of the text's words, of whatever length, that reaches the coefficient; of runs that overlap, the best stays, then the
    one that begins first. So a licence is found inside a line, across lines and across blocks, with words lost, added or replaced, wherever it
    begins; touching copies of a licence may be one. Licences whose notices differ in few words are each reported.

    `position` counts a kind's units from 0, and is the number of the first word of a passage. Words are runs of letters and digits,
    lower-cased, with one spelling of licence; bigrams count as often as they occur. Of several templates, the best stays for a line, block or text, then
    the first by name. Null and blank texts have no unit; repeated rows count once; a null doc_id is kept. Extra columns are
    ignored; an empty table gives an empty result.

    A text is cut into words only if it holds one of the words without which no template can be reached. Sizes are bounded before bigrams are made; only
    bigrams of some template leave a task, once for each place of a unit, and the templates (given by the caller, some hundred rows) are broadcast. A run that
    is best begins and ends at bigrams of its template, so that only these are tried, each with those within the greatest size
    after it; and only places with enough others within that reach.
    """
    spark = docs.sparkSession
    rows = template_rows(templates or TEMPLATES, least)
    known = spark.createDataFrame(rows, "licence string, number int, size int, low int, high int, bigram string, wanted int")
    low, high, most = min(r[3] for r in rows), max(r[4] for r in rows), max(r[6] for r in rows)

    anchors = anchor_words(rows)
    held = F.exists(F.array(_spelled(F.col("text"))), lambda t: reduce(lambda x, y: x | y, (F.contains(t, F.lit(w)) for w in anchors)))  # spelled once for all
    words = docs.where("text is not null").where(held).select("doc_id", "text", F.transform(F.split("text", "\n"), _words).alias("lines"))
    unit = lambda kind, at, x: F.struct(F.lit(kind).alias("unit"), at.cast("int").alias("position"), x.alias("words"))
    no_units = F.expr("cast(array() as array<struct<unit:string,position:int,words:array<string>>>)")
    lines = F.transform("lines", lambda x, k: unit("line", k, x))
    blocks = F.when(F.col("text").rlike(r"\n[ \t\r]*\n"), F.transform(F.split("text", r"\n[ \t\r]*\n"), lambda x, k: unit("block", k, _words(x)))).otherwise(no_units)
    whole = F.when(F.size("lines") > 1, F.array(unit("text", F.lit(0), F.flatten("lines")))).otherwise(no_units)
    fitting = F.filter(F.concat(lines, blocks, whole), lambda u: F.size(u["words"]).between(low + 1, high + 1))
    passage = F.filter(F.array(unit("passage", F.lit(0), F.flatten("lines"))), lambda u: F.size(u["words"]) > low)
    units = words.select("doc_id", F.explode(F.concat(fitting, passage)).alias("u"))
    units = units.select("doc_id", "u.unit", "u.position", F.col("u.words").alias("words"), F.xxhash64("u.words").alias("of"))
    pairs = F.transform(F.expr("slice(words, 1, size(words) - 1)"), lambda x, k: F.concat(x, F.lit(" "), F.get("words", k + 1)))
    grams = units.select("doc_id", "unit", "position", "of", (F.size("words") - 1).alias("n"), F.posexplode(pairs).alias("place", "bigram"))

    key = ["doc_id", "unit", "position", "of", "n", "licence", "number"]
    met = grams.join(F.broadcast(known), "bigram").where((F.col("unit") == "passage") | F.col("n").between(F.col("low"), F.col("high"))).dropDuplicates([*key, "place"])
    met = materialise(met, "bigrams")  # read twice

    counted = met.where("unit <> 'passage'").groupBy(*key, "size", "bigram").agg(F.least(F.count("*"), F.max("wanted")).alias("shared"))
    dice = (2.0 * F.sum("shared") / (F.col("n") + F.col("size"))).alias("dice")
    alike = counted.groupBy(*key, "size").agg(dice).where(F.col("dice") >= least)
    best = alike.groupBy("doc_id", "unit", "position").agg(F.min(F.struct((-F.col("dice")).alias("less"), "licence")).alias("best"))
    best = best.select("doc_id", "unit", "position", F.col("best.licence").alias("licence"), (-F.col("best.less")).alias("dice"))
    return best.union(_passages(met.where("unit = 'passage'"), most, least))


def _passages(met: DataFrame, most: int, least: float) -> DataFrame:
    """The best runs between two places of a template's bigrams; `most` is the greatest count of one bigram in a template."""
    own = ["doc_id", "of", "licence", "number"]
    reach = F.col("place") / F.col("high")
    near = F.count("*").over(Window.partitionBy(*own).orderBy(reach).rangeBetween(-1, 1))
    dense = met.withColumn("near", near).where(F.col("near") >= F.col("low"))
    # In a run that begins after `before`, this place is not one too many of its bigram.
    earlier = Window.partitionBy(*own, "bigram").orderBy("place")
    before = F.coalesce(*(F.when(F.col("wanted") == k, F.lag("place", k).over(earlier)) for k in range(1, most + 1)), F.lit(-1))
    ahead = F.collect_list(F.struct("place", "before")).over(Window.partitionBy(*own).orderBy(reach).rangeBetween(0, 1))
    runs = dense.withColumn("before", before).withColumn("ahead", ahead)
    counts = F.filter("ahead", lambda x: x["before"] < F.col("place"))
    ends = F.transform(counts, lambda x, k: F.struct((-2.0 * (k + 1) / (x["place"] - F.col("place") + 1 + F.col("size"))).alias("less"), x["place"].alias("last")))
    scored = runs.select("doc_id", "of", "licence", "place", F.array_min(ends).alias("end")).where(F.col("end.less") <= -least)

    in_order = Window.partitionBy("doc_id", "of", "licence").orderBy("place", "end.last", "end.less")
    reached = F.max("end.last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    marked = scored.withColumn("fresh", F.when(F.col("place") <= reached, 0).otherwise(1)).withColumn("run", F.sum("fresh").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    best = marked.groupBy("doc_id", "of", "licence", "run").agg(F.min(F.struct("end.less", "place")).alias("best"))
    found = best.groupBy("doc_id", F.col("best.place").cast("int").alias("position"), "licence").agg((-F.min("best.less")).alias("dice"))
    return found.select("doc_id", F.lit("passage").alias("unit"), "position", "licence", "dice")


def licence_sql(templates: dict[str, list[str]] | None = None, least: float = 0.8) -> str:
    """The same scan in DuckDB's SQL, with the templates as values; the coefficient has nine decimals."""
    q = lambda s: "'" + s.replace("'", "''") + "'"
    values = ",\n".join(f"({q(a)}, {b}, {c}, {d}, {e}, {q(f)}, {g})" for a, b, c, d, e, f, g in template_rows(templates or TEMPLATES, least))
    words = "regexp_extract_all(replace(lower({}), 'licence', 'license'), '[\\p{{L}}\\p{{N}}]+')"
    return f"""
WITH known(licence, number, size, low, high, bigram, wanted) AS (VALUES
{values}),
lines AS (SELECT doc_id, 'line' AS unit, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS position, unnest(string_split(text, chr(10))) AS part FROM documents),
blocks AS (
  SELECT doc_id, 'block' AS unit, generate_subscripts(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n'), 1) - 1 AS position, unnest(regexp_split_to_array(text, '\\n[ \\t\\r]*\\n')) AS part
  FROM documents WHERE regexp_matches(text, '\\n[ \\t\\r]*\\n')),
units AS (SELECT * FROM lines UNION ALL SELECT * FROM blocks UNION ALL SELECT doc_id, 'text', 0, text FROM documents WHERE contains(text, chr(10))),
worded AS (SELECT DISTINCT doc_id, unit, position, {words.format('part')} AS w FROM units),
grams AS (SELECT doc_id, unit, position, len(w) - 1 AS n, w[k] || ' ' || w[k + 1] AS bigram FROM (SELECT *, unnest(range(1, len(w))) AS k FROM worded)),
shared AS (
  SELECT doc_id, unit, position, n, licence, number, size, least(count(*), max(wanted)) AS shared
  FROM grams JOIN known USING (bigram) WHERE n BETWEEN low AND high GROUP BY doc_id, unit, position, n, licence, number, size, bigram),
scored AS (SELECT doc_id, unit, position, licence, 2.0::DOUBLE * sum(shared) / (n + size) AS dice FROM shared GROUP BY doc_id, unit, position, n, licence, number, size),
ranked AS (SELECT *, row_number() OVER (PARTITION BY doc_id, unit, position ORDER BY dice DESC, licence) AS r FROM scored WHERE dice >= {least}),
texts AS (SELECT doc_id, w, md5(array_to_string(w, ' ')) AS h FROM (SELECT DISTINCT doc_id, {words.format('text')} AS w FROM documents)),
places AS (SELECT doc_id, h, k - 1 AS place, w[k] || ' ' || w[k + 1] AS bigram FROM (SELECT *, unnest(range(1, len(w))) AS k FROM texts)),
hits AS (SELECT *, row_number() OVER (PARTITION BY doc_id, h, licence, number, bigram ORDER BY place) AS nth FROM places JOIN known USING (bigram)),
limited AS (
  SELECT a.*, coalesce(b.place, -1) AS before FROM hits a LEFT JOIN hits b
  ON a.doc_id IS NOT DISTINCT FROM b.doc_id AND a.h = b.h AND a.licence = b.licence AND a.number = b.number AND a.bigram = b.bigram AND b.nth = a.nth - a.wanted),
tried AS (
  SELECT a.doc_id, a.h, a.licence, a.number, a.size, a.place AS begins, b.place AS ends,
         count(*) OVER (PARTITION BY a.doc_id, a.h, a.licence, a.number, a.place ORDER BY b.place ROWS UNBOUNDED PRECEDING) AS shared
  FROM limited a JOIN limited b ON a.doc_id IS NOT DISTINCT FROM b.doc_id AND a.h = b.h AND a.licence = b.licence AND a.number = b.number
  AND b.place BETWEEN a.place AND a.place + a.high AND b.before < a.place),
likes AS (SELECT *, 2.0::DOUBLE * shared / (ends - begins + 1 + size) AS dice FROM tried),
chosen AS (SELECT * FROM likes WHERE dice >= {least} QUALIFY row_number() OVER (PARTITION BY doc_id, h, licence, number, begins ORDER BY dice DESC, ends) = 1),
marked AS (
  SELECT *, CASE WHEN begins <= max(ends) OVER (PARTITION BY doc_id, h, licence ORDER BY begins, ends, dice DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM chosen),
runs AS (SELECT *, sum(fresh) OVER (PARTITION BY doc_id, h, licence ORDER BY begins, ends, dice DESC ROWS UNBOUNDED PRECEDING) AS run FROM marked),
passages AS (SELECT doc_id, licence, begins AS position, dice FROM runs QUALIFY row_number() OVER (PARTITION BY doc_id, h, licence, run ORDER BY dice DESC, begins) = 1)
SELECT doc_id, unit, CAST(position AS INTEGER) AS position, licence, round(dice, 9) AS dice FROM ranked WHERE r = 1
UNION ALL
SELECT doc_id, 'passage', CAST(position AS INTEGER), licence, round(max(dice), 9) FROM passages GROUP BY doc_id, licence, position
"""
