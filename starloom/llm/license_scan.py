"""License notices and whole licenses by MinHash bands over overlapping text windows, with DataFrame
functions only.

A text is its runs of the letters a-z (after lower-casing) and digits, and its shingles are the runs of
five of them. Templates are retrieved in one of two ways and then verified by the exact share of their
shingles that the text contains:

- Templates of ``LONG`` shingles or more, by bands. Windows of ``WINDOW`` shingles begin at every
  ``STRIDE``-th shingle, and one more ends with the text, so each shingle lies in two windows at
  least (but for the first and last ``STRIDE``). One hash deals a window's shingles into ``BINS`` bins; the
  smallest of each bin is a row, two rows are a band. Of a template every window is taken. So a
  window of the text that lies in an unchanged part of a template has all its bands. If a text holds four
  fifths of a template's shingles, then so does one of its windows over it: their similarity is two thirds
  at least, two rows agree with a chance of 0.44, and one of eight bands with 0.99; a template of ``LONG``
  shingles has three such windows or more, which all fail for one in a million.
- Shorter templates by all their shingles: a band would lie in few windows there. Nothing is lost.

All is done in the task that reads the text: nothing but matches is shuffled.

Null and empty texts contain no license. Templates of less than five words are one shingle as
a whole and would match nothing: they are refused. Rows that repeat a doc_id count as one
document with the union of their matches; a null doc_id is a document too. An empty table gives no
rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm.common import query, table, texts

SHINGLE, WINDOW, STRIDE, BINS, LONG = 5, 64, 32, 16, 128

# Public license notices as they are written into files, and licenses in full.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": "Unless required by applicable law or agreed to in writing, software "
    "distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR "
    "CONDITIONS OF ANY KIND, either express or implied.",
    "MIT": "Released under the MIT License.",
    "MIT-notice": "Permission is hereby granted, free of charge, to any person obtaining a copy of "
    "this software and associated documentation files (the Software), to deal in the Software "
    "without restriction.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under "
    "the terms of the GNU General Public License as published by the Free Software Foundation.",
    "LGPL-notice": "This library is free software; you can redistribute it and/or modify it under "
    "the terms of the GNU Lesser General Public License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, "
    "v. 2.0.",
    "BSD-notice": "Redistribution and use in source and binary forms, with or without "
    "modification, are permitted provided that the following conditions are met.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International "
    "License.",
    "MIT-full": "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
    "software and associated documentation files (the Software), to deal in the Software without "
    "restriction, including without limitation the rights to use, copy, modify, merge, publish, "
    "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the "
    "Software is furnished to do so, subject to the following conditions: The above copyright notice "
    "and this permission notice shall be included in all copies or substantial portions of the "
    "Software. THE SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, "
    "INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
    "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, "
    "DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, "
    "OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
    "BSD-2-Clause-full": "Redistribution and use in source and binary forms, with or without "
    "modification, are permitted provided that the following conditions are met: 1. Redistributions "
    "of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this "
    "list of conditions and the following disclaimer in the documentation and/or other materials "
    "provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND "
    "CONTRIBUTORS AS IS AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO "
    "EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF "
    "SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF "
    "THE POSSIBILITY OF SUCH DAMAGE.",
}


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def shingles(w: str = "words") -> Column:
    """The runs of five words, as text."""
    inside = ", ".join(f"{w}[i + {k}]" for k in range(SHINGLE))
    return F.expr(
        f"if(size({w}) < {SHINGLE}, cast(array() as array<string>), "
        f"transform(sequence(0, size({w}) - {SHINGLE}), i -> concat_ws(' ', {inside})))"
    )


def hashes(w: str = "hashed_words") -> Column:
    """A hash of each run of five words, from the hashes of the words."""
    inside = ", ".join(f"{w}[i + {k}]" for k in range(SHINGLE))
    return F.expr(
        f"if(size({w}) < {SHINGLE}, cast(array() as array<bigint>), "
        f"transform(sequence(0, size({w}) - {SHINGLE}), i -> xxhash64({inside})))"
    )


def bands(h: str = "hashes", stride: int = STRIDE) -> Column:
    """The bands of all windows of an array of shingle hashes that has WINDOW of them at least. A bin
    is the leading bits of a hash, so in a sorted window the first hash of each bin is its smallest."""
    shift = 64 - (BINS - 1).bit_length()

    def bin_of(value: str) -> str:
        return f"shiftrightunsigned({value}, {shift})"

    starts = f"array_union(sequence(0, size({h}) - {WINDOW}, {stride}), array(size({h}) - {WINDOW}))"
    rows = (
        f"transform({starts}, p -> transform(array(sort_array(slice({h}, p + 1, {WINDOW}))), w -> "
        f"filter(w, (v, j) -> {bin_of('v')} != {bin_of(f'w[if(j + 1 < {WINDOW}, j + 1, 0)]')}"
        f" OR j = {WINDOW - 1}))[0])"
    )
    pairs = (
        f"transform({rows}, m -> transform(filter(sequence(0, greatest(size(m) - 2, 0)), j -> "
        f"{bin_of('m[j]')} % 2 = 0 AND {bin_of('m[least(j + 1, size(m) - 1)]')} = {bin_of('m[j]')} + 1), "
        "j -> xxhash64(m[j], m[j + 1])))"
    )
    return F.expr(f"if(size({h}) < {WINDOW}, cast(array() AS array<bigint>), flatten({pairs}))")


def _hashed(rows: DataFrame) -> DataFrame:
    """``words`` and ``hashes`` (of the shingles) of each text."""
    return (
        rows.withColumn("words", words(F.col("text")))
        .withColumn("hashed_words", F.expr("transform(words, w -> xxhash64(w))"))
        .withColumn("hashes", hashes())
    )


def templates(spark: SparkSession, texts_by_name: dict[str, str]) -> DataFrame:
    """license, template_shingles (distinct), whether it is long, and the keys it is retrieved by."""
    rows = spark.createDataFrame(sorted(texts_by_name.items()), "license string, text string")
    return _hashed(rows).select(
        "license",
        F.array_distinct(shingles()).alias("template_shingles"),
        F.expr(f"size(array_distinct(hashes)) >= {LONG}").alias("is_long"),
        F.array_distinct(bands(stride=1)).alias("bands"),
        F.array_distinct("hashes").alias("short_keys"),
    ).selectExpr(
        "license", "template_shingles", "is_long", "if(is_long, bands, short_keys) AS keys"
    )


def _longs(values) -> Column:
    return F.array(*(F.lit(value).cast("bigint") for value in values))


def _matches(docs: DataFrame, known: list) -> DataFrame:
    """doc_id, license, shared and template_size for each document and each template that has a key of
    it: a shingle, or a band if the template is long."""
    any_long = any(row["is_long"] for row in known)
    table_of = F.array(
        *(
            F.struct(
                F.lit(row["license"]).alias("license"),
                F.array(*map(F.lit, row["template_shingles"])).alias("template_shingles"),
                _longs(row["keys"]).alias("keys"),
            )
            for row in known
        )
    )
    every = sorted({value for row in known for value in row["keys"]})
    keys = F.concat("hashes", bands()) if any_long else F.col("hashes")
    retrieved = (
        _hashed(texts(docs))
        .select("doc_id", "words", F.array_intersect(keys, _longs(every)).alias("hit"))
        .withColumn("known", table_of)
    )
    # The outer form of explode keeps the optimizer from repeating all of the above in a filter.
    return (
        retrieved.select(
            "doc_id",
            "words",
            F.explode_outer(F.expr("filter(known, t -> arrays_overlap(hit, t.keys))")).alias(
                "template"
            ),
        )
        .where("template is not null")
        .select(
            "doc_id",
            "template.license",
            F.size(F.array_intersect("template.template_shingles", shingles())).alias("shared"),
            F.size("template.template_shingles").alias("template_size"),
        )
    )


def license_matches(
    docs: DataFrame,
    texts_by_name: dict[str, str] | None = None,
    threshold: float = 0.8,
    per_pass: int = 100,
) -> DataFrame:
    """doc_id, license, shared (shingles of the template that the text contains), template_size
    and containment, for each document and template with a containment of at least ``threshold``.

    Templates become part of the plan, ``per_pass`` of them at once; the texts are read once per pass.
    """
    spark = docs.sparkSession
    texts_by_name = TEMPLATES if texts_by_name is None else texts_by_name
    known = templates(spark, texts_by_name).collect()
    missing = [row["license"] for row in known if not row["template_shingles"]]
    if missing:
        raise ValueError(f"templates of less than {SHINGLE} words: {missing}")
    passes = [known[i : i + per_pass] for i in range(0, len(known), per_pass)]
    return (
        reduce(DataFrame.unionByName, (_matches(docs, part) for part in passes))
        .groupBy("doc_id", "license")
        .agg(F.max("shared").alias("shared"), F.max("template_size").alias("template_size"))
        .withColumn("containment", F.col("shared") / F.col("template_size"))
        .where(F.col("containment") >= threshold)
    )


def _oracle() -> str:
    rows = ", ".join(
        "('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES.items()
    )
    runs = (
        "list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])"
    )
    return f"""WITH t AS (SELECT license, {runs} AS s FROM (SELECT license,
    regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM (VALUES {rows}) v(license, text))),
d AS (SELECT doc_id, {runs} AS s FROM (SELECT doc_id,
    regexp_extract_all(lower(text), '[a-z0-9]+') AS w FROM documents)),
p AS (SELECT doc_id, unnest(s) AS s FROM d),
q AS (SELECT license, len(s) AS n, unnest(s) AS s FROM t)
SELECT doc_id, license, count(*)::INTEGER AS shared, any_value(n)::INTEGER AS template_size,
  count(*) / any_value(n) AS containment
FROM p JOIN q USING (s) GROUP BY doc_id, license HAVING count(*) / any_value(n) >= 0.8"""


@query("op1_license_scan", _oracle())
def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_matches(table(spark, folder, "documents"))
