"""License scans by MinHash bands over overlapping text windows, in DataFrame functions only.

Templates of one size make a class of c words, a quarter more than a template. A document is cut into windows of 2c
words, one every c, so any passage of up to c words lies whole in a window. Of each window and template, minima over
seeded hashes of five-word shingles are compared, one minimum a band. A template of s shingles of which LEAST or more are
in a window of 2c - 4 has a Jaccard index J of least(s) / (s + 2c - 4 - least(s)) or more with it, which is 0.29 for long
templates and 0.1 for one of five words. Each template has as many bands b as make (1 - J)^b, the chance that none agrees,
MISS at most; then the containment of the template's shingles in the window is counted exactly.

A band agrees only if the window holds the template's minimal shingle. So windows without any such shingle need no
minima: they are passed over, and the result is the same.

Templates of under five words have no shingle. They are found by a rule of their own: wherever their words follow each
other. Templates are part of a plan; where they are too many for one, further plans take the rest.
"""

from __future__ import annotations

import json
import string
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_folder, table

WORDS, LEAST, MISS = 5, 0.8, 1e-6
#: Words of the templates that one plan takes (one template at least): their hashes are literals of some 2 MB.
PLAN_WORDS = 100_000
_SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

# Notices and texts as the licenses or their stewards word them.
TEMPLATES = {
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted. THE SOFTWARE IS PROVIDED
"AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR
PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE.""",
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance
with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in
writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or
implied. See the License for the specific language governing permissions and limitations under the License.""",
    "BSD-2-Clause-terms": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution.""",
    "BSD-3-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation
and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to
endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND
CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A
PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR
BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE)
ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation
covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of
the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following: The copyright notices in the Software
and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the
Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of
machine-executable object code generated by a source language processor. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL
THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING
FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-3.0-notice": """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as
published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
above copyright notice and this permission notice appear in all copies.""",
    "MIT": "Released under the MIT License.",
    "MIT-full": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED
"AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION
OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "MIT-grant": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute,
sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.""",
    "MPL-2.0-notice": """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed
with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    "Unlicense": """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or
distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In
jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public
domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be
an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising
from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it
and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you
wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not
required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may
not be removed or altered from any source distribution.""",
}


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with value computed once: a lambda's variable is never inlined, whatever the optimizer does."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    """Runs of digits, letters and characters beyond ASCII, with A-Z lowered."""
    low = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.array_remove(F.split(low, _SEPARATORS), "")


def grams(w: Column, k: int = WORDS) -> Column:
    """A hash of each run of k words, in order, repeats included."""
    none = F.array().cast("array<bigint>")
    each = lambda i: F.xxhash64(*(F.get(w, i + j) for j in range(k)))
    return F.when(F.size(w) >= k, F.transform(F.sequence(F.lit(0), F.size(w) - k), each)).otherwise(none)


def shingles(text: Column) -> Column:
    return let(words(text), grams)


def _enough(size: Column, c: Column) -> Column:
    """The bands of a template with so many distinct shingles in a class of c words."""
    least = F.ceil(LEAST * size - 1e-9)
    index = least / (size + 2 * c - WORDS + 1 - least)
    return F.ceil(F.log(F.lit(MISS)) / F.log(1 - index)).cast("int")


def _minima(distinct: Column, bands: Column) -> Column:
    """For each band, the smallest seeded hash, with its shingle."""
    return F.transform(
        F.sequence(F.lit(0), bands - 1),
        lambda j: F.array_min(F.transform(distinct, lambda x: F.struct(F.xxhash64(x, j).alias("least"), x.alias("shingle"))))
    )


def _bands(distinct: Column, bands: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), bands - 1), lambda j: F.xxhash64(j, F.array_min(F.transform(distinct, lambda x: F.xxhash64(x, j)))))


def _rows(spark: SparkSession, templates: dict[str, str]) -> list:
    """Of each template: its name, number of words n, class c, distinct shingles s, bands b and their minimal shingles; of
    one of under five words, s is the hash of them all. Templates without words are never found."""
    sizes = spark.createDataFrame(sorted(templates.items()), "license string, text string").withColumn("w", words(F.col("text")))
    sizes = sizes.withColumn("n", F.size("w")).where("n > 0").withColumn("c", F.ceil(5 * F.col("n") / 4).cast("int"))
    whole = F.array(F.when(F.col("n") == 1, F.xxhash64(F.get("w", F.lit(0)))))
    for k in range(2, WORDS):
        whole = F.when(F.col("n") == k, grams(F.col("w"), k)).otherwise(whole)
    made = sizes.withColumn("s", F.when(F.col("n") < WORDS, whole).otherwise(F.array_distinct(grams(F.col("w")))))
    made = made.withColumn("k", F.when(F.col("n") < WORDS, 1).otherwise(_enough(F.size("s"), F.col("c"))))
    made = made.withColumn("b", _bands(F.col("s"), F.col("k"))).withColumn("m", _minima(F.col("s"), F.col("k")))
    return made.select("license", "n", "c", "s", "b", F.col("m.shingle").alias("anchors")).collect()  # the templates, not documents


def _plans(rows: list, most: int) -> list[list]:
    """Templates in groups of so many words at most, or of one template."""
    out: list[list] = []
    for r in sorted(rows, key=lambda r: r["c"]):
        if not out or sum(x["n"] for x in out[-1]) + r["n"] > most:
            out.append([])
        out[-1].append(r)
    return out


def _classes(rows: list) -> list[dict]:
    """Templates of five words or more by class: c, the most bands of its templates, the minimal shingles of any band,
    and of each template its name, bands and shingles."""
    out: dict[int, dict] = {}
    for r in (r for r in rows if r["n"] >= WORDS):
        k = out.setdefault(r["c"], {"c": r["c"], "bands": 0, "anchors": set(), "templates": []})
        k["bands"] = max(k["bands"], len(r["b"]))
        k["anchors"] |= set(r["anchors"])
        k["templates"].append({"license": r["license"], "bands": r["b"], "shingles": r["s"]})
    return [k | {"anchors": sorted(k["anchors"])} for _, k in sorted(out.items())]


_FOUND = "array<struct<license: string, containment: double, first_word: int>>"


def _literal(numbers: list[int]) -> Column:
    return F.split(F.lit(",".join(map(str, numbers))), ",").cast("array<bigint>")  # folded to one literal


def matches(s: Column, classes: list[dict]) -> Column:
    """array<struct(license, containment, first_word)> for shingles s: each window and template that agree in a band and
    whose containment is LEAST or more."""
    none = F.array().cast(_FOUND)
    if not classes:
        return none
    kind = "array<struct<c: int, bands: int, anchors: array<bigint>, templates: array<struct<license: string, bands: array<bigint>, shingles: array<bigint>>>>>"
    known = F.from_json(F.lit(json.dumps(classes)), kind)  # folded to one literal
    anchors = _literal(sorted({a for k in classes for a in k["anchors"]}))

    def window(s: Column, k: Column, at: Column) -> Column:
        inside = F.array_distinct(F.slice(s, at * k["c"] + 1, 2 * k["c"] - WORDS + 1))
        return let(inside, lambda w: let(_bands(w, k["bands"]), lambda b: F.transform(
            F.filter(k["templates"], lambda t: F.arrays_overlap(t["bands"], b)),
            lambda t: F.struct(
                t["license"].alias("license"), (F.size(F.array_intersect(t["shingles"], w)) / F.size(t["shingles"])).alias("containment"),
                (at * k["c"]).alias("first_word")
            ),
        )))

    def windows(s: Column, k: Column) -> Column:
        # the class's anchors in the document are few, however many the class has
        return let(F.array_intersect(s, k["anchors"]), lambda few: F.when(F.size(few) == 0, none).otherwise(near(s, k, few)))

    def near(s: Column, k: Column, few: Column) -> Column:
        hits = F.filter(F.sequence(F.lit(0), F.size(s) - 1), lambda i: F.array_contains(few, F.get(s, i)))
        found = F.array_distinct(
            F.flatten(F.transform(hits, lambda i: F.array((i / k["c"]).cast("int"), F.greatest((i / k["c"]).cast("int") - 1, F.lit(0)))))
        )
        return let(found, lambda n: F.flatten(F.transform(n, lambda at: window(s, k, at))))

    found = F.when(F.arrays_overlap(s, anchors), F.flatten(F.transform(known, lambda k: windows(s, k)))).otherwise(none)
    return F.filter(found, lambda m: m["containment"] >= LEAST)


def notices(w: Column, rows: list) -> Column:
    """The same for templates of under five words: a match wherever words w hold them."""
    out = F.array().cast(_FOUND)
    for k in range(1, WORDS):
        if mine := [r for r in rows if r["n"] == k]:
            names = F.map_from_entries(
                F.from_json(F.lit(json.dumps([{"key": r["s"][0], "value": r["license"]} for r in mine])), "array<struct<key: bigint, value: string>>")
            )
            hit = lambda g, i: F.struct(names[g].alias("license"), F.lit(1.0).alias("containment"), i.alias("first_word"))  # noqa: B023, E731
            there = lambda g: F.filter(F.transform(g, hit), lambda m: m["license"].isNotNull())  # noqa: B023, E731
            hashes = _literal([r["s"][0] for r in mine])
            out = F.concat(out, let(grams(w, k), lambda g: F.when(F.arrays_overlap(g, hashes), there(g)).otherwise(F.array().cast(_FOUND))))  # noqa: B023
    return out


def scan(docs: DataFrame, templates: dict[str, str] | None = None, plan_words: int = PLAN_WORDS) -> DataFrame:
    """doc_id, license, containment, n_windows, first_word: a row for each row of docs(doc_id, text) and license found in it.

    containment is the largest of any window, n_windows how many windows match, first_word where the first of them
    begins; of a template of under five words, n_windows counts its places and containment is 1. Null, empty and short
    texts match nothing; rows that repeat give rows each; no templates, or an empty table, give no rows. Templates of any
    number and size are taken, plan by plan. Windows of one document are a row's arrays and are summed up there, so
    nothing is shuffled and a text costs its task memory in proportion to its size."""
    spark, parts = docs.sparkSession, []
    rows = _rows(spark, TEMPLATES if templates is None else templates) if templates != {} else []
    for group in _plans(rows, plan_words) or [[]]:
        classes = _classes(group)
        found = let(words(F.col("text")), lambda w: F.concat(let(grams(w), lambda s: matches(s, classes)), notices(w, group)))  # noqa: B023
        # an outer explode, so that no filter is derived from it that would compute the matches a second time
        each = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.explode_outer(_summed(found)).alias("m")).where("m is not null")
        parts.append(each.select("doc_id", "m.license", "m.containment", "m.n_windows", "m.first_word"))
    if len(parts) == 1:
        return parts[0]
    folder = new_folder(spark, "licenses")
    for i, part in enumerate(parts):
        part.write.parquet(f"{folder}/{i}")
    return spark.read.schema(parts[0].schema).parquet(*(f"{folder}/{i}" for i in range(len(parts))))


def _summed(found: Column) -> Column:
    """The matches of one text by license."""
    def of(m: Column, name: Column) -> Column:
        return let(F.filter(m, lambda x: x["license"] == name), lambda own: F.struct(
            name.alias("license"), F.array_max(F.transform(own, lambda x: x["containment"])).alias("containment"),
            F.size(own).cast("long").alias("n_windows"), F.array_min(F.transform(own, lambda x: x["first_word"])).alias("first_word"),
        ))

    return let(found, lambda m: F.transform(F.array_distinct(F.transform(m, lambda x: x["license"])), lambda name: of(m, name)))


def op2_minhash_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, license, containment, n_windows, first_word for all of documents and the templates above."""
    return scan(table(spark, sf_dir, "documents"))


def _oracle() -> str:
    rows = ",\n".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in TEMPLATES.items())
    split = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    grams = "list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))"
    return f"""
with t(license, text) as (values {rows}),
tw as (select license, {split} as w from t),
ts as (select license, cast(ceil(len(w) * 1.25) as int) as c, list_distinct({grams}) as s from tw),
dw as (select row_number() over () as r, doc_id, {split} as w from documents),
ds as (select r, doc_id, {grams} as s from dw where len(w) >= 5),
x as (select r, doc_id, license, a, len(list_intersect(ts_s, list_distinct(s[a + 1:a + 2 * c - 4]))) / len(ts_s) as containment
      from (select r, doc_id, license, c, ds.s as s, ts.s as ts_s, unnest(range(0, len(ds.s), c)) as a from ds, ts))
select doc_id, license, max(containment) as containment, count(*) as n_windows, cast(min(a) as int) as first_word from x where containment >= 0.8
group by r, doc_id, license
"""


ORACLE = _oracle()
