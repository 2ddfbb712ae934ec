r"""License scans by diagonal voting.

All rolling hashes of K words of a text meet the positions of the same hashes in the templates in a Spark join. Each meeting
votes for the diagonal word - position of its template; neighbouring diagonals (a few words put in or left out) are merged
into one span. A span that covers enough of its template's grams is verified by its words: enough of the template's words must
stand there in their order (the longest common subsequence; their share is the score), and no telling word may refute it:
another number where the template has the version that its label names, or a word of KINDS inside the span that the template
hasn't. Of two spans that overlap, the one with the more covered grams stays, then that of the higher share; equal ones both
stay. The templates, short notices and whole licenses, are a constant of some two thousand words, so the join broadcasts them,
and a bitmap of their hashes drops, before the join and without loss, what cannot meet any. Texts are scanned once: what is
kept of them is a narrow row each, with the hits and the words beside them.

Phrases (the base) are found exactly: their words stand one after the other, compared as text and not only by hash.

Cases: null is the empty text, with no words; a text of any length is scanned whole; texts that repeat give the same rows; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import map_arrow, row_key, settled, slices, table
from .words import HashSet, Words

K, APART, ENOUGH = 3, 3, 0.6
#: Words that make another license of one that goes on alike, and how far from a hit words are kept.
KINDS, AROUND = ("lesser", "library", "affero", "noncommercial", "sharealike", "noderivatives", "noderivs", "nc", "sa", "nd"), 8
PHRASES = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
#: (label, wording): notices as they stand at the head or foot of a text, and whole licenses.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "this project is licensed under the terms of the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("apache-2", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-nc", "creative commons attribution noncommercial 4 0 international license"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-sa", "creative commons attribution sharealike 4 0 international license"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-3", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license"),
    ("gpl-2", "licensed under the gnu general public license version 2"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl-3", "licensed under the gnu affero general public license version 3"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("all-rights-reserved", "all rights reserved"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution 3 neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required 2 altered source versions must be plainly marked as such and must not be misrepresented as being the original software 3 this notice may not be removed or altered from any source distribution"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license"),
    ("gpl-3", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details"),
]


def template_versions(templates=TEMPLATES) -> list[tuple[int, str | None, int | None, list[str]]]:
    """(template, version that its label names, its position, the kinds that the wording has)."""
    rows = []
    for t, (label, wording) in enumerate(templates):
        words, version = wording.split(), label.rpartition("-")[2]
        named = version.isdigit() and version in words
        rows.append((t, version if named else None, words.index(version) if named else None, [x for x in KINDS if x in words]))
    return rows


def template_grams(templates=TEMPLATES, k: int = K) -> list[tuple[int, int, int, str, int]]:
    """(hash as a signed long, template, position, label, grams of the template)."""
    rows = []
    for t, (label, wording) in enumerate(templates):
        hashes = Words([wording]).grams(k)[1]
        rows += [(int(h.astype(np.int64)), t, p, label, len(hashes)) for p, h in enumerate(hashes)]
    return rows


SCHEMA = "key string, doc_id long, n_words long, n_base long, first_word long, last_word long, base array<string>, hits array<struct<hash:long,word:long>>, words array<struct<word:long,token:string>>"


SPAN = ["key", "template", "label", "span", "covered", "first_word", "last_word", "low", "high"]
VERIFIED = "s_key string, s_template int, s_label string, s_span long, s_covered int, s_first_word long, s_last_word long, s_low long, s_high long, s_words array<struct<word:long,token:string>>, score double"


def _scanner(phrases: dict[str, str], hashes: list[int], k: int):
    known = HashSet(np.array(hashes, dtype=np.int64).astype(np.uint64))
    bases = [(p.split(" "), label, Words([p]).grams(len(p.split(" ")))[1]) for p, label in phrases.items()]
    lengths = sorted({len(p) for p, _, _ in bases})
    schema = pa.schema([("key", pa.string()), ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base", pa.list_(pa.string())), ("hits", pa.list_(pa.struct([("hash", pa.int64()), ("word", pa.int64())]))), ("words", pa.list_(pa.struct([("word", pa.int64()), ("token", pa.string())])))])

    def scan(batch):
        ids, texts, keys = (batch.column(i).to_pylist() for i in range(3))
        texts = [t or "" for t in texts]
        for a, b in slices(texts):
            w = Words(texts[a:b])
            n = np.diff(w.first)
            found: list[list[tuple[int, str]]] = [[] for _ in range(b - a)]
            hits: list[list[dict]] = [[] for _ in range(b - a)]
            for length in lengths:
                at, h = w.grams(length)
                for phrase, label, own in bases:
                    if len(phrase) == length:
                        for i in at[h == own[0]]:
                            if [w.word(i + j) for j in range(length)] == phrase:
                                found[w.doc[i]].append((int(i - w.first[w.doc[i]]), label))
            at, h = w.grams(k)
            where, _ = known.find(h)
            for i, x in zip(at[where], h[where].astype(np.int64)):
                d = w.doc[i]
                hits[d].append({"hash": int(x), "word": int(i - w.first[d])})
            # The words near a hit: what a span is verified by.
            near = np.zeros(len(w.hash) + 1, dtype=np.int64)
            np.add.at(near, np.maximum(at[where] - AROUND, 0), 1)
            np.add.at(near, np.minimum(at[where] + k + AROUND, len(w.hash)), -1)
            beside: list[list[dict]] = [[] for _ in range(b - a)]
            for i in np.flatnonzero(np.cumsum(near[:-1]) > 0):
                beside[w.doc[i]].append({"word": int(i - w.first[w.doc[i]]), "token": w.word(i)})
            columns = [
                keys[a:b], ids[a:b], [int(x) for x in n], [len(f) for f in found],
                [min(f)[0] if f else None for f in found], [max(f)[0] if f else None for f in found],
                [sorted({x for _, x in f}) for f in found], hits, beside,
            ]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    return scan


def in_order(template: list[str], text: list[str]) -> int:
    """How many of the template's words stand in the text in their order, at most: the longest common subsequence, a word of text at a time on the bits of one number."""
    places: dict[str, int] = {}
    for i, w in enumerate(template):
        places[w] = places.get(w, 0) | 1 << i
    full = open_ = (1 << len(template)) - 1
    for w in text:
        met = open_ & places.get(w, 0)
        open_ = (open_ + met | open_ - met) & full
    return len(template) - open_.bit_count()


def _verified(templates, enough: float, apart: int):
    """The spans of which enough of the template's words stand in their order, with their share as score."""
    wordings = [t.split() for _, t in templates]

    def each(batch):
        scores = []
        for template, low, high, words in zip(*(batch.column(i).to_pylist() for i in range(4))):
            own = wordings[template]
            here = [x["token"] for x in words if low - apart <= x["word"] < high + len(own) + apart]
            scores.append(in_order(own, here) / len(own))
        keep = pa.array([x >= enough for x in scores])
        out = pa.RecordBatch.from_arrays([*batch.columns[4:], pa.array(scores, pa.float64())], names=[*batch.schema.names[4:], "score"])
        yield out.filter(keep)

    return each


def scan_licenses(docs: DataFrame, templates=TEMPLATES, phrases: dict[str, str] = PHRASES, k: int = K, apart: int = APART, enough: float = ENOUGH) -> tuple[DataFrame, DataFrame]:
    """(one row a document with its base and n_words, one row a verified span: key, template, label, first_word, last_word, score).

    key stands for (doc_id, text); rows that repeat share it, and their spans count once.
    """
    grams = template_grams(templates, k)
    rows = docs.select("doc_id", "text", row_key().alias("key"))
    scanned = settled(map_arrow(rows, _scanner(phrases, [g[0] for g in grams], k), SCHEMA))
    # As many rows as the templates have words: a constant.
    places = F.broadcast(docs.sparkSession.createDataFrame(grams, "hash long, template int, position int, label string, grams int"))
    hit = scanned.where(F.size("hits") > 0)
    votes = hit.select("key", F.explode("hits").alias("hit")).select("key", "hit.hash", "hit.word").join(places, "hash")
    votes = votes.withColumn("diagonal", F.col("word") - F.col("position"))
    diagonals = votes.groupBy("key", "template", "label", "grams", "diagonal").agg(F.collect_set("position").alias("positions"))
    order = Window.partitionBy("key", "template").orderBy("diagonal")
    fresh = (F.col("diagonal") - F.lag("diagonal").over(order) > apart).cast("int")
    spans = diagonals.withColumn("span", F.sum(F.coalesce(fresh, F.lit(1))).over(order))
    spans = spans.groupBy("key", "template", "label", "grams", "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("positions")))).alias("covered"),
        F.min(F.col("diagonal") + F.array_min("positions")).alias("first_word"),
        F.max(F.col("diagonal") + F.array_max("positions") + k - 1).alias("last_word"),
        F.min("diagonal").alias("low"),
        F.max("diagonal").alias("high"),
    )
    # Few spans cover enough; only these meet their text's words again.
    beside = hit.dropDuplicates(["key"]).select("key", "words")
    spans = spans.where(F.col("covered") / F.col("grams") >= enough).join(beside, "key")
    spans = map_arrow(spans.select("template", "low", "high", "words", *[F.col(c).alias(f"s_{c}") for c in SPAN], F.col("words").alias("s_words")), _verified(templates, enough, apart), VERIFIED)
    spans = spans.select(*[F.col(f"s_{c}").alias(c) for c in SPAN], F.col("s_words").alias("words"), "score")
    # Numbers, a v before one aside.
    numbers = F.filter(F.transform("words", lambda t: F.struct(t["word"].alias("word"), F.regexp_extract(t["token"], r"^v?([0-9]+)$", 1).alias("token"))), lambda t: t["token"] != "")
    versions = F.broadcast(docs.sparkSession.createDataFrame(template_versions(templates), "template int, version string, version_at int, kinds array<string>"))
    spans = spans.join(versions, "template")
    stated = F.filter(numbers, lambda t: (t["word"] - F.col("version_at")).between(F.col("low") - apart, F.col("high") + apart))
    other = F.coalesce(F.get(F.array_sort(stated), F.lit(0))["token"] != F.col("version"), F.lit(False))
    kind = F.exists("words", lambda t: t["word"].between(F.col("first_word"), F.col("last_word")) & t["token"].isin(*KINDS) & ~F.array_contains("kinds", t["token"]))
    spans = spans.where(~other & ~kind)
    # Wordings share their stock phrases: of spans that overlap, the best covered stays, and a span that went takes no other along. Only spans of one chain can overlap.
    place = Window.partitionBy("key").orderBy("first_word", "last_word", "template", "span")
    apart_ = F.col("first_word") > F.max("last_word").over(place.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("place", F.sum(F.coalesce(apart_.cast("int"), F.lit(1))).over(place))
    chain = spans.groupBy("key", "place").agg(F.sort_array(F.collect_list(F.struct("covered", "score", "template", "label", "first_word", "last_word")), asc=False).alias("chain"))
    better = lambda y, x: (y["first_word"] <= x["last_word"]) & (x["first_word"] <= y["last_word"]) & ((y["covered"] > x["covered"]) | ((y["covered"] == x["covered"]) & (y["score"] > x["score"])))
    kept = F.aggregate("chain", F.slice("chain", 1, 0), lambda held, x: F.when(F.exists(held, lambda y: better(y, x)), held).otherwise(F.concat(held, F.array(x))))
    spans = chain.select("key", F.explode(kept).alias("s")).select("key", "s.*")
    return scanned.drop("hits", "words"), spans.select("key", "template", "label", "first_word", "last_word", "score")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned, spans = scan_licenses(table(spark, sf_dir, "documents"))
    found = spans.groupBy("key").agg(F.collect_set("label").alias("more"), F.max("score").alias("score"))
    out = scanned.join(found, "key", "left")
    labels = F.array_sort(F.array_union(F.col("base"), F.coalesce(F.col("more"), F.array().cast("array<string>"))))
    score = F.when(F.size("base") > 0, 1.0).otherwise(F.coalesce(F.col("score"), F.lit(0.0)))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base", ",").alias("base_labels"), F.array_join(labels, ",").alias("labels"), score.alias("score"))
