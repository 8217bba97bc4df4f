"""License scans: an exact set-similarity join of text blocks with license templates.

Tokens are pairs of neighbouring words, so a match has the template's words in its order.
A template of T words is compared with blocks of 2 T words that overlap by half, so every
run of T words lies in one, wherever lines break. A block matches if it contains at least
``containment`` of the template's distinct tokens. The join tests few blocks:

- tokens are ordered by how many documents have them, rarest first;
- prefix: of a template of t tokens that needs o, one of its t - o + 1 rarest
  tokens must be in the block, and in the document;
- length: a block with fewer than o template tokens cannot match;
- position: the tokens after the first shared one must still suffice on both sides.

What is left is verified exactly. Every text is lower-cased and split once; a table of the places of
template tokens in each document serves the frequencies, the blocks and the base
labels, which are places where a phrase's words stand one after another. DataFrame
functions only.

Defined results: null text counts as empty; repeated rows get equal
results; first_word and last_word are null without a base place; score is 1
with a base place, else the best containment found, else 0.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skylane.llm.common import Stash

BREAK = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"

# The phrases of the base labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Usual notices of well-known licenses, then texts that files carry whole.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("cc", "Licensed under CC BY 4.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("rights-reserved", "All rights reserved"),
    (
        "apache-header",
        """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with
        the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by
        applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS,
        WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language
        governing permissions and limitations under the License.""",
    ),
    (
        "bsd-2-clause",
        """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the
        following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
        conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice,
        this list of conditions and the following disclaimer in the documentation and/or other materials provided with the
        distribution.""",
    ),
    (
        "bsd-3-clause",
        """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
        products derived from this software without specific prior written permission.""",
    ),
    (
        "bsd-disclaimer",
        """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
        INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
        DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL,
        SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
        SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,
        WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
        OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    ),
    (
        "gpl-notice",
        """This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public
        License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later
        version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
        implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more
        details. You should have received a copy of the GNU General Public License along with this program. If not, see
        https://www.gnu.org/licenses/.""",
    ),
    (
        "isc",
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby
        granted, provided that the above copyright notice and this permission notice appear in all copies.""",
    ),
    (
        "mit-text",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated
        documentation files (the "Software"), to deal in the Software without restriction, including without limitation the
        rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit
        persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and
        this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS
        PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
        MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT
        HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE,
        ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    (
        "mpl-header",
        """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not
        distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.""",
    ),
    (
        "unlicense",
        """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish,
        use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose,
        commercial or non-commercial, and by any means.""",
    ),
]


def words(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; an empty array without any.

    Other letters change case too, which no word of ASCII letters can tell, but for the Kelvin sign.
    """
    parts = F.split(F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit("K"), F.lit("ĸ"))), BREAK)
    head = F.when(F.get(parts, F.lit(0)) == "", 1).otherwise(0)
    tail = F.when((F.size(parts) > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)
    return F.slice(parts, head + 1, F.greatest(F.size(parts) - head - tail, F.lit(0)))


def template_words(text: str) -> list[str]:
    """The same on the driver, for the templates and phrases (ASCII)."""
    return "".join(c if c.isalnum() else " " for c in text.lower()).split()


def template_tokens(text: str) -> list[str]:
    """The tokens of a template or phrase, in order."""
    ws = template_words(text)
    return [f"{a} {b}" for a, b in zip(ws, ws[1:])]


def token_places(ws: Column, tokens: list[str]) -> Column:
    """Array of (pos, token) where one of ``tokens`` stands in the words of a text, in order."""
    first = sorted({t.split(" ")[0] for t in tokens})
    pair = lambda i: F.concat_ws(" ", F.get(ws, i), F.get(ws, i + 1))
    places = F.filter(F.sequence(F.lit(0), F.size(ws) - 2), lambda i: F.get(ws, i).isin(first) & pair(i).isin(tokens))
    none = F.array().cast("array<struct<pos:int,token:string>>")
    return F.when(F.size(ws) > 1, F.transform(places, lambda i: F.struct(i.alias("pos"), pair(i).alias("token")))).otherwise(none)


def phrase_places(hits: Column, phrases: dict[str, str]) -> Column:
    """Array of (start, label) where the words of a phrase stand one after another."""

    def places(phrase: str, label: str) -> Column:
        q = template_tokens(phrase)
        if not q:
            raise ValueError(f"a phrase has two words or more: {phrase!r}")
        more = lambda h: [F.array_contains(hits, F.struct((h["pos"] + j).alias("pos"), F.lit(t).alias("token"))) for j, t in enumerate(q) if j]
        found = F.filter(hits, lambda h: reduce(lambda a, b: a & b, more(h), h["token"] == q[0]))
        return F.transform(found, lambda h: F.struct(h["pos"].cast("long").alias("start"), F.lit(label).alias("label")))

    return F.concat(*(places(p, label) for p, label in phrases.items()))


def template_matches(rows: DataFrame, templates: list[tuple[str, str]], containment: float) -> DataFrame:
    """(row, label, share) for each block that contains a template; ``rows`` has row, n_words and hits."""
    spark = rows.sparkSession
    sets = [(label, len(template_words(t)), sorted(set(template_tokens(t)))) for label, t in templates]
    vocabulary = sorted({t for _, _, s in sets for t in s})
    # document frequency of the templates' tokens: as many rows as the templates have tokens
    many = rows.select(F.explode(F.array_distinct("hits.token")).alias("t")).groupBy("t").agg(F.count("*").alias("n")).collect()
    often = {r["t"]: r["n"] for r in many}
    rank = {t: k for k, t in enumerate(sorted(vocabulary, key=lambda t: (often.get(t, 0), t)))}
    index = []
    for k, (label, size, s) in enumerate(sets):
        s = sorted(rank[t] for t in s)
        need = math.ceil(containment * len(s) - 1e-9)
        index += [(r, size, k, label, i, need, s) for i, r in enumerate(s[: len(s) - need + 1])]
    prefixes = spark.createDataFrame(index, "rank int, words int, template int, label string, at int, need int, tokens array<int>")
    grids = spark.createDataFrame(sorted({(t, rank[t], size) for _, size, s in sets for t in s}), "token string, rank int, words int")
    least = {size: min(i[5] for i in index if i[1] == size) for _, size, _ in sets}
    # a document without any prefix token has no matching block
    by_rank = sorted(rank, key=rank.get)
    rare = [by_rank[r] for r in sorted({i[0] for i in index})]
    near = rows.filter(F.exists("hits.token", lambda t: t.isin(rare)))
    token = near.select("row", "n_words", F.explode("hits").alias("h")).select("row", "n_words", "h.pos", "h.token").join(F.broadcast(grids), "token")
    # the blocks of 2 T words from k T on that hold both words of the pair
    k = F.floor(F.col("pos") / F.col("words")).cast("int")
    fits = lambda b: (b >= 0) & (b * F.col("words") < F.greatest(F.col("n_words") - F.col("words"), F.lit(1))) & (F.col("pos") + 1 < (b + 2) * F.col("words"))
    token = token.select("row", "words", "rank", F.explode(F.filter(F.array(k, k - 1), fits)).alias("block"))
    blocks = token.groupBy("row", "words", "block").agg(F.sort_array(F.collect_set("rank")).alias("have"))
    enough = reduce(lambda c, x: c.when(F.col("words") == x[0], x[1]), least.items(), F.when(F.lit(False), 0))
    blocks = blocks.filter(F.size("have") >= enough)
    tried = blocks.select("row", "words", "have", F.posexplode("have").alias("pos", "rank")).join(F.broadcast(prefixes), ["rank", "words"])
    left = lambda n, at: n - 1 - F.col(at)
    tried = tried.filter((F.size("have") >= F.col("need")) & (1 + F.least(left(F.size("tokens"), "at"), left(F.size("have"), "pos")) >= F.col("need")))
    # the first shared token speaks for the pair
    shared = F.array_intersect("tokens", "have")
    tried = tried.filter(F.get(shared, F.lit(0)) == F.col("rank")).filter(F.size(shared) >= F.col("need"))
    return tried.select("row", "label", (F.size(shared) / F.size("tokens")).alias("share"))


def scan_licenses(docs: DataFrame, containment: float = 0.8, phrases: dict[str, str] | None = None, templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """``docs`` without text, with n_words, n_base, first_word, last_word, base_labels, labels and score.

    Other columns are passed on; columns of these names are replaced.
    """
    own = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    templates, phrases = templates or TEMPLATES, phrases or PHRASES
    tokens = sorted({t for _, text in templates for t in template_tokens(text)} | {t for p in phrases for t in template_tokens(p)})
    rest = docs.drop("text", *own).columns
    split = docs.select(F.struct(*rest).alias("rest"), words(F.col("text")).alias("ws"))
    # written once: a row keeps its number, and no text is read again
    rows = split.select(F.monotonically_increasing_id().alias("row"), "rest", F.size("ws").cast("long").alias("n_words"), token_places(F.col("ws"), tokens).alias("hits"))
    rows = Stash(docs.sparkSession).write(rows)
    found = template_matches(rows, templates, containment).groupBy("row").agg(F.collect_set("label").alias("more"), F.max("share").alias("share"))
    out = rows.select("row", "rest", "n_words", phrase_places(F.col("hits"), phrases).alias("places")).join(found, "row", "left")
    starts, labels = F.col("places.start"), F.array_distinct("places.label")
    none = F.array().cast("array<string>")
    return out.select(
        "rest.*",
        "n_words",
        F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(labels, F.coalesce("more", none))), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("share", F.lit(0.0))).alias("score"),
    )
