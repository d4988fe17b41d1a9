"""Licence notices by a positional index of rare words; built-in functions only.

A template is the wording of a notice, a sentence or a whole body, with a mandatory key phrase in it.
One pass counts the documents that hold each word of the templates.  The index has, for every such word,
its postings (template, offset).  A file is looked up by its rarest words: of each template whose key
phrase it can hold, the ``RAREST`` words that the file holds with the highest inverse document frequency
(ties go to the smaller word).  Each place of one of them, less the offset of a posting, is a start.
Postings are intersected by relative position: a start stands if ``VOTES`` places agree on it.  Then at
least ``SHARE`` percent of the whole template must be in place, and last the key phrase word for word.
So a phrase alone is no notice, and a notice with some words changed is one.  The score is the share of
a template's words that stand in place.

Texts are gone through once; what is kept of them is written down.  The rest happens within a row,
on arrays: no shuffle but for the word counts (one row for each word of the templates), and the
candidates of a file are sorted, not compared with each other, so a long or repetitive text costs
n log n.

Defined cases: a null or empty text has no words, no places, no labels and score 0; null ids and
repeated rows are returned as they are; ties of frequency go to the smaller word; other columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxelspark.llm.common import ascii_lower, cut, table

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_RAW_WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"  # the same before lower-casing
#: Base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Label, wording of the notice, mandatory key phrase (a part of the wording).
TEMPLATES = (
    ("mit-notice", "released under the mit license", "the mit license"),
    ("mit-grant", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "hereby granted free of charge"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-grant", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation", "lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "source and binary forms"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "copy modify and or distribute this software"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "free and unencumbered software"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    ("cc", "this work is licensed under a creative commons attribution license", "creative commons attribution"),
    ("mit-notice-kept", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "substantial portions of the software"),
    ("no-warranty", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement", "without warranty of any kind"),
    ("apache-header", "you may not use this file except in compliance with the license you may obtain a copy of the license at", "except in compliance with the license"),
    ("gpl-or-later", "either version 3 of the license or at your option any later version", "at your option any later version"),
    ("bsd-source", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer", "must retain the above copyright notice"),
    ("bsd-names", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "endorse or promote products derived from this software"),
    ("mit-body", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions", "to deal in the software without restriction"),
    ("bsd-binary", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "in binary form must reproduce"),
    ("bsd-disclaimer", "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage", "even if advised of the possibility"),
    ("isc-body", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies", "with or without fee"),
    ("isc-warranty", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits", "the author disclaims all warranties"),
    ("apache-body", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license", "unless required by applicable law"),
    ("gpl-body", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details", "in the hope that it will be useful"),
    ("gpl-preamble", "the gnu general public license is a free copyleft license for software and other kinds of works the licenses for most software and other practical works are designed to take away your freedom to share and change the works by contrast the gnu general public license is intended to guarantee your freedom to share and change all versions of a program to make sure it remains free software for all its users", "designed to take away your freedom"),
    ("lgpl-preamble", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license supplemented by the additional permissions listed below", "supplemented by the additional permissions"),
    ("mpl-body", "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0", "if a copy of the mpl"),
    ("unlicense-body", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means", "anyone is free to copy"),
    ("cc-by-deed", "you are free to share copy and redistribute the material in any medium or format and adapt remix transform and build upon the material for any purpose even commercially", "remix transform and build upon"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely", "held liable for any damages"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "accompanying documentation covered"),
)
_SPLIT = [t.split() for _, t, _ in TEMPLATES]
_PHRASES = [p.split() for _, _, p in TEMPLATES]
VOCABULARY = sorted({w for t in _SPLIT for w in t})
#: Words that a file is looked up by for each template, places that must agree on a start, and percent
#: of a template's words that must be in place.
RAREST, VOTES, SHARE = 6, 2, 70
_AT = [next(i for i in range(len(t)) if t[i : i + len(p)] == p) for t, p in zip(_SPLIT, _PHRASES, strict=True)]
def _list(values, quote=repr) -> str:
    return "array(" + ", ".join(map(quote, values)) + ")"


def _lower(words, text):
    """Words in lower case.  Other letters than A-Z change case too, which no template has; in texts
    with one of the two that would become a letter of ASCII, they are kept from it."""
    odd = F.coalesce(text.contains("\u0130") | text.contains("\u212a"), F.lit(False))
    return F.when(odd, F.transform(words, ascii_lower)).otherwise(F.transform(words, F.lower))


def read(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_words, held, w), written down: the number of words, the distinct
    words of the templates, and all words in lower case where a phrase can stand, else none.  Texts
    are gone through once."""
    phrases = [*_PHRASES, *(p.split() for p, _ in BASE)]
    d = docs.select("doc_id", "text", F.regexp_extract_all("text", F.lit(_RAW_WORD), F.lit(0)).alias("raw"))
    d = d.withColumn("held", F.array_intersect(_lower(F.array_distinct("raw"), F.col("text")), F.expr(_list(sorted({*VOCABULARY, *(w for p in phrases for w in p)})))))
    may = F.lit(False)
    for p in phrases:
        may = may | F.forall(F.expr(_list(p)), lambda w: F.array_contains("held", w))
    none = F.expr("CAST(array() AS array<string>)")
    w = F.when(may, _lower("raw", F.col("text"))).otherwise(none)
    return cut(d.select("doc_id", F.coalesce(F.size("raw"), F.lit(0)).cast("long").alias("n_words"), F.coalesce("held", none).alias("held"), F.coalesce(w, none).alias("w")))


def frequencies(held: DataFrame) -> dict[str, int]:
    """Documents that hold each word of the templates: at most one number for each of them."""
    found = {r.w: r["count"] for r in held.select(F.explode("held").alias("w")).groupBy("w").count().collect()}
    return {w: found.get(w, 0) for w in VOCABULARY}


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, text) -> (doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, hits), hits: the templates found, with their first word's place and agreeing words."""
    d = read(docs)
    often = frequencies(d)
    # The distinct words of each template, the rarest first.
    ordered = "array(" + ", ".join(_list(sorted(set(t), key=lambda w: (often[w], w))) for t in _SPLIT) + ")"
    postings = "array(" + ", ".join(f"struct('{w}' AS w, {t} AS t, {o} AS o)" for t, words in enumerate(_SPLIT) for o, w in enumerate(words)) + ")"
    templates = "array(" + ", ".join(_list(t) for t in _SPLIT) + ")"
    phrases = "array(" + ", ".join(_list(p) for p in _PHRASES) + ")"
    # Places of the base phrases end in "license".
    d = d.withColumn("ends", F.expr("filter(transform(w, (x, i) -> IF(x = 'license', i, -1)), i -> i > 0)"))
    d = d.withColumn("base", F.expr("""
        array_sort(filter(transform(ends, i -> CASE
            WHEN w[i - 1] = 'mit' THEN struct(CAST(i - 1 AS BIGINT) AS at, 'mit' AS label)
            WHEN w[i - 1] = 'apache' THEN struct(CAST(i - 1 AS BIGINT) AS at, 'apache' AS label)
            WHEN i > 1 AND w[i - 1] = 'public' AND w[i - 2] = 'general' THEN struct(CAST(i - 2 AS BIGINT) AS at, 'gpl' AS label)
            END), b -> b IS NOT NULL))"""))
    d = d.withColumn("asked", F.expr(f"""
        transform(filter(sequence(0, {len(TEMPLATES) - 1}), t -> forall({phrases}[t], x -> array_contains(held, x))),
            t -> struct(t AS t, slice(filter({ordered}[t], x -> array_contains(held, x)), 1, {RAREST}) AS rare))"""))
    d = d.withColumn("looked", F.expr("array_distinct(flatten(asked.rare))"))
    d = d.withColumn("found", F.expr("filter(transform(IF(size(asked) > 0, w, slice(w, 1, 0)), (x, i) -> struct(x AS w, i AS i)), o -> array_contains(looked, o.w))"))
    # The postings of the words that this file is looked up by, and for the templates that ask for them.
    d = d.withColumn("posted", F.expr(f"filter({postings}, p -> exists(asked, a -> a.t = p.t AND array_contains(a.rare, p.w)))"))
    d = d.withColumn("places", F.expr("""
        array_sort(flatten(transform(found, o -> transform(filter(posted, p -> p.w = o.w), p -> struct(p.t AS t, o.i - p.o AS s)))))"""))
    # Places that agree stand next to each other: the first of each group that has enough stays.
    d = d.withColumn("starts", F.expr(f"filter(places, (x, i) -> coalesce(get(places, i + {VOTES - 1}) = x, false) AND (i = 0 OR get(places, i - 1) <> x))"))
    d = d.withColumn("hits", F.expr(f"""
        filter(transform(starts, x -> struct(x.t AS t, x.s AS s, {_list([t[0] for t in TEMPLATES])}[x.t] AS label, CAST(x.s AS BIGINT) AS start,
            size(filter({templates}[x.t], (y, o) -> x.s + o >= 0 AND coalesce(get(w, x.s + o) = y, false))) AS agree,
            size({templates}[x.t]) AS most)),
            h -> h.agree * 100 >= h.most * {SHARE} AND h.s + {_list(_AT, str)}[h.t] >= 0
                AND slice(w, h.s + {_list(_AT, str)}[h.t] + 1, size({phrases}[h.t])) = {phrases}[h.t])"""))
    d = d.withColumn("hits", F.expr("transform(hits, h -> struct(h.label, h.start, h.agree, h.most))"))
    base_labels = F.expr("array_sort(array_distinct(transform(base, b -> b.label)))")
    labels = F.expr("array_sort(array_distinct(concat(transform(base, b -> b.label), transform(hits, h -> h.label))))")
    score = F.coalesce(F.array_max(F.expr("transform(hits, h -> CAST(h.agree AS DOUBLE) / h.most)")), F.expr("IF(size(base) > 0, 0.5D, 0D)"))
    return d.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(F.expr("transform(base, b -> b.at)")).alias("first_word"), F.array_max(F.expr("transform(base, b -> b.at)")).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"), "hits",
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).drop("hits")


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(x) if isinstance(x, (int, str)) else str(list(x)) for x in r) + ")" for r in rows)


ORACLE = rf"""
WITH tpl(t, label, words, phrase, pos) AS (VALUES {_values((t, TEMPLATES[t][0], _SPLIT[t], _PHRASES[t], _AT[t]) for t in range(len(TEMPLATES)))}),
d AS MATERIALIZED (
  SELECT row_number() OVER () AS k, doc_id,
    coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}'), []) AS w FROM documents),
x AS MATERIALIZED (SELECT k, unnest(w) AS w, unnest(range(len(w))) AS i FROM d),
post AS MATERIALIZED (SELECT t, unnest(words) AS w, unnest(range(len(words))) AS o FROM tpl),
held AS MATERIALIZED (SELECT DISTINCT k, w FROM x WHERE w IN (SELECT w FROM post)),
df AS (SELECT w, count(*) AS n FROM held GROUP BY w),
may AS (
  SELECT k, t FROM (SELECT t, len(list_distinct(phrase)) AS n, unnest(list_distinct(phrase)) AS w FROM tpl) p JOIN held USING (w) GROUP BY k, t, n HAVING count(*) = n),
rare AS (
  SELECT k, t, w FROM (SELECT k, t, w, row_number() OVER (PARTITION BY k, t ORDER BY n, w) AS r FROM may JOIN (SELECT DISTINCT t, w FROM post) USING (t) JOIN held USING (k, w) JOIN df USING (w)) q WHERE r <= {RAREST}),
place AS (SELECT k, t, x.i - post.o AS s FROM rare JOIN x USING (k, w) JOIN post USING (t, w) GROUP BY 1, 2, 3 HAVING count(*) >= {VOTES}),
hit AS (
  SELECT k, label, agree::DOUBLE / len(words) AS score FROM (
    SELECT p.k, label, words, phrase, pos, s, d.w, len(list_filter(range(len(words)), lambda o: s + o >= 0 AND s + o < len(d.w) AND d.w[s + o + 1] = words[o + 1])) AS agree
    FROM place p JOIN tpl USING (t) JOIN d ON d.k = p.k) q
  WHERE agree * 100 >= len(words) * {SHARE} AND s + pos >= 0 AND list_slice(w, s + pos + 1, s + pos + len(phrase)) = phrase),
base AS (
  SELECT a.k, CASE b.w WHEN 'mit' THEN a.i - 1 WHEN 'apache' THEN a.i - 1 ELSE a.i - 2 END AS pos,
    CASE b.w WHEN 'mit' THEN 'mit' WHEN 'apache' THEN 'apache' ELSE 'gpl' END AS label
  FROM x a JOIN x b ON a.w = 'license' AND b.k = a.k AND b.i = a.i - 1 LEFT JOIN x c ON c.k = a.k AND c.i = a.i - 2 AND b.w = 'public'
  WHERE b.w IN ('mit', 'apache') OR (b.w = 'public' AND c.w = 'general')),
bs AS (SELECT k, count(*) AS n, min(pos) AS lo, max(pos) AS hi, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM base GROUP BY k),
ls AS (SELECT k, string_agg(DISTINCT label, ',' ORDER BY label) AS l FROM (SELECT k, label FROM base UNION ALL SELECT k, label FROM hit) GROUP BY k),
hs AS (SELECT k, max(score) AS score FROM hit GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(bs.n, 0) AS BIGINT) AS n_base, CAST(bs.lo AS BIGINT) AS first_word, CAST(bs.hi AS BIGINT) AS last_word,
  coalesce(bs.l, '') AS base_labels, coalesce(ls.l, '') AS labels,
  coalesce(hs.score, CASE WHEN bs.n > 0 THEN 0.5 ELSE 0 END)::DOUBLE AS score
FROM d LEFT JOIN bs USING (k) LEFT JOIN ls USING (k) LEFT JOIN hs USING (k)
"""
