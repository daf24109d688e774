"""License scan: MinHash bands over overlapping windows, exact containment.

SQL functions only; one pass over the whole texts without shuffle.

A text is its sequence of 5-word shingles (words in lower case, without
marks). Windows of 16 shingles start every 4 shingles, so that any 19 shingles
in a row hold a whole window. A window's signature is the smallest and the
largest of its shingle hashes under four masks (the largest is the smallest
under the complemented mask): eight values, taken in pairs as eight bands.
Templates of 16 shingles or more are cut into windows at every offset. A
window alike to a template window to 0.75 shares a band with probability
1 - (1 - 0.75^2)^8, above 99.8 percent, and an equal one always. A shorter
template is retrieved by windows of one shingle, whose MinHash is its hash.

Texts with a window in some template's bands are verified: the share of a
template's distinct shingles that the text contains, exactly. Short templates
must be contained whole: "version 2" and "version 3" differ in one word. SPDX lines are
too short for shingles: a pattern reads them, whatever license they name.

Templates are a parameter (a few hundred texts at most): their bands and
hashes travel with the plan as literals.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import shingle_hashes

WIDTH = 5
PERCENT = 75
STEP = 4
BLOCKS = 4
WINDOW = STEP * BLOCKS
MASKS = (0x1F83D9ABFB41BD6B, 0x5BE0CD19137E2179, 0x243F6A8885A308D3, 0x6A09E667F3BCC908)

# Fixed texts: notices as their licenses state them.
TEMPLATES: dict[str, str] = {
    "apache-2.0-line": "Licensed under the Apache License, Version 2.0.",
    "apache-2.0-header": (
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License."
    ),
    "mit-line": "Released under the MIT License.",
    "mit-grant": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
        'associated documentation files (the "Software"), to deal in the Software without restriction, including '
        "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
        "copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the "
        "following conditions: The above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the Software."
    ),
    "bsd-redistribution": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
        "that the following conditions are met: Redistributions of source code must retain the above copyright "
        "notice, this list of conditions and the following disclaimer. Redistributions in binary form must "
        "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
        "documentation and/or other materials provided with the distribution."
    ),
    "isc-grant": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted, provided that the above copyright notice and this permission notice appear in all copies."
    ),
    "gpl-3.0-line": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-notice": (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        "General Public License as published by the Free Software Foundation, either version 3 of the License, or "
        "(at your option) any later version. This program is distributed in the hope that it will be useful, but "
        "WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR "
        "PURPOSE. See the GNU General Public License for more details."
    ),
    "lgpl-notice": (
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser "
        "General Public License as published by the Free Software Foundation; either version 2.1 of the License, "
        "or (at your option) any later version."
    ),
    "mpl-2.0-notice": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
    ),
    "cc-by-4.0-line": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4.0-line": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0-line": "To the extent possible under law, the author has waived all copyright and related rights to this work.",
    "unlicense": (
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, "
        "publish, use, compile, sell, or distribute this software, either in source code form or as a compiled "
        "binary, for any purpose, commercial or non-commercial, and by any means."
    ),
    "mit-warranty": (
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
        "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
        "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
        "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
        "USE OR OTHER DEALINGS IN THE SOFTWARE."
    ),
    "bsd-warranty": (
        'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
        "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
        "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
        "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
        "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
        "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
        "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
        "POSSIBILITY OF SUCH DAMAGE."
    ),
    "bsd-3-endorsement": (
        "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
        "promote products derived from this software without specific prior written permission."
    ),
    "agpl-notice": (
        "under the terms of the GNU Affero General Public License as published by the Free Software Foundation, "
        "either version 3 of the License, or (at your option) any later version."
    ),
    "bsl-1.0-grant": (
        "Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the "
        'software and accompanying documentation covered by this license (the "Software") to use, reproduce, '
        "display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software"
    ),
    "bsl-1.0-line": "Distributed under the Boost Software License, Version 1.0.",
    "zlib-grant": (
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
        "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
        "use this software for any purpose, including commercial applications, and to alter it and redistribute it "
        "freely, subject to the following restrictions"
    ),
    "epl-2.0-notice": (
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0"
    ),
    "epl-1.0-notice": (
        "All rights reserved. This program and the accompanying materials are made available under the terms of the "
        "Eclipse Public License v1.0"
    ),
    # Headings, by which full texts are known.
    "apache-2.0-heading": "Apache License Version 2.0, January 2004",
    "gpl-2.0-heading": "GNU GENERAL PUBLIC LICENSE Version 2, June 1991",
    "gpl-3.0-heading": "GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "agpl-3.0-heading": "GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007",
    "lgpl-2.1-heading": "GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999",
    "lgpl-3.0-heading": "GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007",
    "cc0-1.0-heading": "CC0 1.0 Universal Public Domain Dedication",
}
# Short forms: "under (the) <name>", for each name by which a license goes.
NAMES = {
    "agpl-3.0": ("AGPL-3.0", "AGPLv3 license", "GNU Affero General Public License"),
    "apache-2.0": ("Apache License 2.0", "Apache 2.0 license", "Apache-2.0 license"),
    "bsd-2-clause": ("BSD 2-Clause License", "2-clause BSD license", "Simplified BSD License"),
    "bsd-3-clause": ("BSD 3-Clause License", "3-clause BSD license", "New BSD License"),
    "bsl-1.0": ("Boost Software License",),
    "cc0-1.0": ("CC0 1.0", "CC0 license"),
    "epl": ("Eclipse Public License",),
    "gpl-2.0": ("GPL-2.0 license", "GPLv2 license", "GNU General Public License version 2", "GNU General Public License v2"),
    "gpl-3.0": ("GPL-3.0 license", "GPLv3 license", "GNU General Public License version 3", "GNU General Public License v3"),
    "isc": ("ISC License",),
    "lgpl": ("GNU Lesser General Public License",),
    "mit": ("MIT License",),
    "mpl-2.0": ("Mozilla Public License", "MPL 2.0 license"),
    "zlib": ("zlib License",),
}
for _id, _names in NAMES.items():
    for _k, _name in enumerate(_names):
        for _verb in ("licensed", "released", "distributed", "available"):
            TEMPLATES[f"{_id}-{_verb}-{_k}"] = f"{_verb} under the {_name}"
        TEMPLATES[f"{_id}-terms-{_k}"] = f"under the terms of the {_name}"
# Creative Commons: "CC BY-NC 4.0" and the long name, of each kind and version.
CC_KINDS = {
    "by": "Attribution",
    "by-sa": "Attribution-ShareAlike",
    "by-nc": "Attribution-NonCommercial",
    "by-nc-sa": "Attribution-NonCommercial-ShareAlike",
    "by-nd": "Attribution-NoDerivatives",
    "by-nc-nd": "Attribution-NonCommercial-NoDerivatives",
}
for _kind, _long in CC_KINDS.items():
    for _version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
        # "CC BY 4.0" alone has four words: it needs the one before.
        _before = "under " if _kind == "by" else ""
        TEMPLATES[f"cc-{_kind}-{_version}-short"] = f"{_before}CC {_kind} {_version}"
        TEMPLATES[f"cc-{_kind}-{_version}-name"] = f"Creative Commons {_long} {_version}"
SPDX = (
    r"SPDX-License-Identifier:[ \t]*\(*([A-Za-z0-9][A-Za-z0-9.+-]*"
    r"(?:[ \t()]+(?:AND|OR|WITH)[ \t(]+[A-Za-z0-9][A-Za-z0-9.+-]*)*)"
)


def _words(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def _spdx(text: Column) -> Column:
    """Matches of SPDX lines: one per expression, ``spdx:`` and the expression."""

    def one(e: Column) -> Column:
        before = F.regexp_replace(text, F.concat(F.lit(r"(?s)SPDX-License-Identifier:[ \t]*\(*\Q"), e, F.lit(r"\E(?![A-Za-z0-9.+-]*[A-Za-z0-9+]).*")), F.lit(""))
        return F.struct(
            F.concat(F.lit("spdx:"), e).alias("license_id"), F.lit(1).alias("shared"), F.lit(1).alias("total"), F.size(_words(before)).alias("first")
        )

    named = F.transform(F.regexp_extract_all(text, F.lit(SPDX), F.lit(1)), lambda e: F.rtrim(e, F.lit(".")))
    return F.transform(F.array_distinct(named), one)


def _with_shingles(df: DataFrame, text: Column) -> DataFrame:
    return df.withColumn("__w", _words(text)).withColumn("__h", shingle_hashes("__w", WIDTH)).drop("__w")


def _with_windows(df: DataFrame) -> DataFrame:
    """Adds ``__v0`` to ``__v7``: per window of ``__h`` the signature values.
    Minima are taken over blocks of STEP shingles once, then over BLOCKS of
    them; windows that reach beyond the text end with it."""
    blocks = F.ceil(F.size("__h") / F.lit(STEP)).cast("int")
    df = df.withColumn("__blocks", F.when(blocks > 0, F.sequence(F.lit(0), blocks - 1)).otherwise(F.array().cast("array<int>")))

    def turned(mask: int) -> Column:
        return F.transform("__h", lambda h: h.bitwiseXOR(F.lit(mask)))

    df = df.withColumns({f"__t{k}": turned(m) for k, m in enumerate(MASKS)})
    extremes = [(f, k) for k in range(len(MASKS)) for f in (F.array_min, F.array_max)]

    def per_block(extreme, k: int) -> Column:
        return F.transform("__blocks", lambda b: extreme(F.slice(F.col(f"__t{k}"), b * STEP + 1, F.lit(STEP))))

    def per_window(least, i: int) -> Column:
        # Each use of the column counts: used once only, it would be computed anew per element.
        b = F.col(f"__b{i}")
        return F.transform(b, lambda x, at: least(x, *[F.get(b, at + k) for k in range(1, BLOCKS)]))

    df = df.withColumns({f"__b{i}": per_block(f, k) for i, (f, k) in enumerate(extremes)})
    df = df.withColumns({f"__v{i}": per_window((F.least, F.greatest)[i % 2], i) for i in range(len(extremes))})
    return df.drop(*[f"__t{k}" for k in range(len(MASKS))], *[f"__b{i}" for i in range(len(extremes))])


def _band(j: int, window: Column) -> Column:
    n = 2 * len(MASKS)
    return F.xxhash64(F.lit(j), F.get(F.col(f"__v{j}"), window), F.get(F.col(f"__v{(j + 1) % n}"), window))


def _bands(window: Column) -> Column:
    return F.array(*[_band(j, window) for j in range(2 * len(MASKS))])


def _longs(values: list[int]) -> Column:
    """A literal array of longs, as one small expression that folds."""
    if not values:
        return F.array().cast("array<long>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def _templates(spark: SparkSession, templates: Mapping[str, str]) -> tuple[dict[str, list[int]], list[int], list[int]]:
    """Distinct shingle hashes per template, the bands of the long ones'
    windows, and the hashes of the short ones."""
    frame = spark.createDataFrame(sorted(templates.items()), "license_id string, text string")
    hashed = _with_shingles(frame, F.col("text")).select("license_id", "__h")
    sets = {r["license_id"]: sorted(set(r["__h"])) for r in hashed.collect()}
    offsets = F.explode(F.sequence(F.lit(0), F.size("__h") - WINDOW)).alias("offset")
    cut = hashed.filter(F.size("__h") >= WINDOW).select("__h", offsets)
    windows = _with_windows(cut.select(F.slice("__h", F.col("offset") + 1, F.lit(WINDOW)).alias("__h")))
    keys = windows.select(F.explode(_bands(F.lit(0))).alias("key")).distinct()
    long_keys = sorted(r["key"] for r in keys.collect())
    short = sorted({h for r in hashed.collect() if len(r["__h"]) < WINDOW for h in r["__h"]})
    return sets, long_keys, short


def scan_licenses(docs: DataFrame, templates: Mapping[str, str] = TEMPLATES, percent: int = PERCENT) -> DataFrame:
    """``docs`` with ``n_windows`` (distinct template bands and short shingles met) and
    ``matches``: per template of which the text contains at least ``percent``
    percent of the distinct shingles (all of them, if the template has fewer than
    16) a struct ``license_id, shared, total,
    first`` (``first``: place of its first shingle in the text, from 0), by id;
    an SPDX line is a match of id ``spdx:`` and its expression, 1 of 1.

    Defined cases: a null or empty text, or one without words, has no matches;
    a template or text of fewer than five words is one shingle, an empty
    template matches nothing; each repeated row is scanned; other columns pass
    through, those with the names added here are replaced; an empty table gives
    an empty result.
    """
    sets, long_keys, short = _templates(docs.sparkSession, templates)
    d = _with_windows(_with_shingles(docs, F.col("text")))
    d = d.withColumn("__keys", F.flatten(F.transform("__blocks", _bands)))
    long_hits = F.size(F.array_intersect("__keys", _longs(long_keys)))
    short_hits = F.size(F.array_intersect("__h", _longs(short)))
    d = d.withColumn("n_windows", long_hits + short_hits)
    empty = F.array().cast("array<struct<license_id:string,shared:int,total:int,first:int>>")
    # The template shingles met, in text order: few, so each template is checked against them alone.
    met = sorted({h for hashes in sets.values() for h in hashes})
    d = d.withColumn("__met", F.when(F.col("n_windows") > 0, F.array_intersect("__h", _longs(met))).otherwise(F.array().cast("array<long>")))
    checks = []
    for license_id, hashes in sorted(sets.items()):
        if hashes:
            own = _longs(hashes)
            both = F.array_intersect("__met", own)
            shared = F.size(both)
            first = F.array_position("__h", F.get(both, F.lit(0))).cast("int") - 1
            # In a short form each word tells: version, verb or kind.
            least = 100 if len(hashes) < WINDOW else percent
            checks.append(F.when(
                shared * 100 >= len(hashes) * least,
                F.struct(F.lit(license_id).alias("license_id"), shared.alias("shared"), F.lit(len(hashes)).alias("total"), first.alias("first")),
            ))
    matches = F.filter(F.array(*checks), lambda m: m.isNotNull()) if checks else empty
    found = F.when(F.col("n_windows") > 0, matches).otherwise(empty)
    lines = F.when(F.col("text").contains("SPDX-License-Identifier:"), _spdx(F.col("text"))).otherwise(empty)
    d = d.withColumn("matches", F.array_sort(F.concat(found, lines)))
    return d.drop("__h", "__met", "__keys", "__blocks", *[f"__v{i}" for i in range(2 * len(MASKS))])
