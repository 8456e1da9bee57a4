"""Licence scan: passages against licence notices by the Dice coefficient of word bigrams.

Texts are normalised (A-Z lowered, everything but letters, digits and dots is one
blank) and cut into passages: lines, paragraphs and the whole text. A passage and a
notice with a and b different word bigrams, c of them shared, have a coefficient of
``2c / (a + b)``. It can reach the threshold t only if a lies between
``t / (2 - t) * b`` and ``(2 - t) / t * b``; notices outside that bound are never
compared. The same bound on c leaves less than ``b - t / (2 - t) * b`` bigrams of a
notice out, so a text or passage without any of the bigrams that :func:`telling`
picks reaches no notice and is not looked at further. DataFrame functions only, one pass, no shuffle.

Notices inside longer lines or paragraphs, or wrapped under other lines, are found in
windows: wherever a telling bigram of a notice stands among the words of the whole text
(here without the dots at word ends), the window that puts it where the notice has it,
as long as the notice, is compared too. Of overlapping windows the one that shares most
bigrams stays. A window and a passage one of which holds the other are the same find:
the longer one stays, the passage if they are equal.

A notice wins only where the words that change the terms (NC, ND, SA, Lesser, Affero) are
the same and its version is there.

Defined results: null and empty texts have no licence; a passage of one word has
that word as its only bigram. The best notice wins, ties go to the last name in
code point order. Equal passages of a text count once. Repeated rows give repeated
results; other columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

THRESHOLD = 0.75

#: Notices as they stand in files, with the family of their terms.
NOTICES: dict[str, tuple[str, str]] = {
    "Apache-2.0": ("permissive", "Licensed under the Apache License, Version 2.0."),
    "Apache-2.0-long": ("permissive", 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0'),
    "MIT": ("permissive", "Released under the MIT License."),
    "MIT-long": ("permissive", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software'),
    "BSD-3-Clause": ("permissive", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:"),
    "GPL-3.0": ("copyleft", "This work is licensed under the GNU General Public License, version 3."),
    "GPL-3.0-long": ("copyleft", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "LGPL-3.0": ("copyleft", "This library is licensed under the GNU Lesser General Public License, version 3."),
    "AGPL-3.0": ("copyleft", "This work is licensed under the GNU Affero General Public License, version 3."),
    "MPL-2.0": ("copyleft", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    "CC0-1.0": ("public", "To the extent possible under law, the author has waived all copyright and related rights to this work."),
    "CC-BY-4.0": ("attribution", "Licensed under CC BY 4.0."),
    "CC-BY-SA-4.0": ("copyleft", "Licensed under CC BY-SA 4.0."),
    "CC-BY-NC-4.0": ("noncommercial", "Licensed under CC BY-NC 4.0."),
    "CC-BY-NC-4.0-long": ("noncommercial", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    "All-rights-reserved": ("reserved", "All rights reserved."),
    "CC-BY-4.0-long": ("attribution", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    "CC-BY-SA-4.0-long": ("copyleft", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    "CC-BY-ND-4.0": ("noderivatives", "Licensed under CC BY-ND 4.0."),
    "CC-BY-ND-4.0-long": ("noderivatives", "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License."),
    "CC-BY-NC-SA-4.0": ("noncommercial", "Licensed under CC BY-NC-SA 4.0."),
    "CC-BY-NC-SA-4.0-long": ("noncommercial", "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License."),
    "CC-BY-NC-ND-4.0": ("noncommercial", "Licensed under CC BY-NC-ND 4.0."),
    "CC-BY-NC-ND-4.0-long": ("noncommercial", "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License."),
    "CC-BY-3.0-long": ("attribution", "This work is licensed under a Creative Commons Attribution 3.0 Unported License."),
    "CC-BY-SA-3.0-long": ("copyleft", "This work is licensed under a Creative Commons Attribution-ShareAlike 3.0 Unported License."),
    "GPL-2.0": ("copyleft", "This work is licensed under the GNU General Public License, version 2."),
    "GPL-2.0-long": ("copyleft", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    "LGPL-2.1": ("copyleft", "This library is licensed under the GNU Lesser General Public License, version 2.1."),
    "LGPL-2.1-long": ("copyleft", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    "LGPL-3.0-long": ("copyleft", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "AGPL-3.0-long": ("copyleft", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    "BSD-2-Clause-long": ("permissive", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS"),
    "BSD-3-Clause-long": ("permissive", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    "MIT-full": ("permissive", 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.'),
    "ISC": ("permissive", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    "Unlicense": ("public", "This is free and unencumbered software released into the public domain."),
    "EPL-2.0": ("copyleft", "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/"),
    "EPL-1.0": ("copyleft", "All rights reserved. This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html"),
}
#: SPDX lines by family.
SPDX = {
    "permissive": ("Apache-2.0", "MIT", "BSD-2-Clause", "BSD-3-Clause", "ISC"),
    "copyleft": ("GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0", "AGPL-3.0-only", "AGPL-3.0-or-later", "MPL-2.0", "EPL-1.0", "EPL-2.0", "CC-BY-SA-4.0"),
    "public": ("CC0-1.0", "Unlicense"),
    "attribution": ("CC-BY-4.0",),
    "noderivatives": ("CC-BY-ND-4.0",),
    "noncommercial": ("CC-BY-NC-4.0", "CC-BY-NC-SA-4.0", "CC-BY-NC-ND-4.0"),
}
NOTICES |= {f"{x}-spdx": (family, f"SPDX-License-Identifier: {x}") for family, ids in SPDX.items() for x in ids}
#: Words that change the terms, as the words that say them. A notice wins only where the text has the same of them, and its version.
TERMS = {"nc": ("nc", "noncommercial", "commercial"), "nd": ("nd", "noderivatives", "noderivs", "derivatives"), "sa": ("sa", "sharealike", "alike"), "lesser": ("lesser", "lgpl"), "affero": ("affero", "agpl")}
VERSION = r"^v?([1-9](?:\.[0-9])?)\.*$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def bigrams_of(text: str) -> list[str]:
    """The bigrams of a notice, as the expressions below make them."""
    words = re.sub("[^a-z0-9.]+", " ", text.translate(str.maketrans(UPPER, LOWER))).strip(" ").split(" ")
    return list(dict.fromkeys(f"{a} {b}" for a, b in zip(words, words[1:]))) if len(words) > 1 else words


def undotted(text: str) -> str:
    """The text without dots at word ends, as windows are compared."""
    return re.sub(r"[.]+(?![a-z0-9.])", "", text.translate(str.maketrans(UPPER, LOWER)))


def terms_of(words: list[str]) -> tuple[list[str], list[str]]:
    """The words of :data:`TERMS` and the version that a notice has; numbers of clauses are no versions."""
    terms = [t for t, said in TERMS.items() if set(said) & set(words)]
    found = [m[1].removesuffix(".0") for a, w in zip(["", *words], words) if (m := re.match(VERSION, w)) and ("." in m[1] or a == "version")]
    return terms, list(dict.fromkeys(found))


def _agrees(words: Column, terms: Column, versions: Column) -> Column:
    """Whether words have just these terms, and all these versions."""
    said = [F.when(F.arrays_overlap(words, F.array(*[F.lit(w) for w in how])), F.lit(t)) for t, how in TERMS.items()]
    mine = F.filter(F.array(*said), lambda t: t.isNotNull())
    numbers = F.transform(F.filter(words, lambda w: w.rlike(VERSION)), lambda w: F.regexp_replace(F.regexp_extract(w, VERSION, 1), r"\.0$", ""))
    return (F.size(F.array_except(mine, terms)) == 0) & (F.size(F.array_except(terms, mine)) == 0) & (F.size(F.array_except(versions, numbers)) == 0)


def _texts(of: list[str]) -> Column:
    return F.array(*[F.lit(x) for x in of]).cast("array<string>")


def telling(listed: list[list[str]], threshold: float) -> list[str]:
    """Bigrams of which every passage that reaches ``threshold`` with a notice has one.

    Per notice they are more than a passage may lack, and its longest, since other
    texts rarely have them.
    """
    taken: set[str] = set()
    for grams in sorted(listed, key=len):
        lacking = len(grams) - threshold / (2 - threshold) * len(grams)
        for gram in sorted(grams, key=lambda g: (-len(g), g)):
            if len(taken.intersection(grams)) > lacking + 1e-9:
                break
            taken.add(gram)
    return sorted(taken)


def _bigrams(words: Column) -> Column:
    pairs = F.zip_with(F.slice(words, 1, F.size(words) - 1), F.slice(words, 2, F.size(words) - 1), lambda a, b: F.concat_ws(" ", a, b))
    return F.when(F.size(words) > 1, F.array_distinct(pairs)).otherwise(words)


def passages(normal: Column, needed: str) -> Column:
    """Different passages of a normalised text in which the pattern ``needed`` occurs."""
    lines = F.split(normal, "\n")
    paragraphs = F.split(normal, "\n ?\n")
    joined = F.transform(paragraphs, lambda p: F.trim(F.regexp_replace(p, "[ \n]+", " ")))
    whole = F.trim(F.regexp_replace(normal, "[ \n]+", " "))
    return F.filter(F.array_distinct(F.concat(F.transform(lines, lambda x: F.trim(x)), joined, F.array(whole))), lambda p: p.rlike(needed))


def _let(value: Column, then) -> Column:
    """``then(value)``, with ``value`` computed once."""
    return F.transform(F.array(value), then)[0]


def _spans(m: Column) -> Column:
    return F.concat(F.lit(" "), m["said"], F.lit(" "))


def windows(words: Column, listed: list[tuple[str, str, list[str], int]], anchors: dict[str, list[tuple[int, int]]], threshold: float, agrees=None) -> Column:
    """Array of (dice, licence, family, said) of the windows that reach a notice: name, family, bigrams, number of words."""
    kind = "array<struct<k:int,o:int>>"
    starts = F.create_map(*[x for g, at in sorted(anchors.items()) for x in (F.lit(g), F.array(*[F.struct(F.lit(k).alias("k"), F.lit(o).alias("o")) for k, o in at]).cast(kind))])
    sizes, grams = F.array(*[F.lit(n) for *_, n in listed]), F.array(*[F.array(*[F.lit(g) for g in own]) for _, _, own, _ in listed])
    names, families = F.array(*[F.lit(x[0]) for x in listed]), F.array(*[F.lit(x[1]) for x in listed])

    def found(w):
        n = F.size(w)
        pairs = F.zip_with(F.slice(w, 1, F.greatest(n - 1, F.lit(0))), F.slice(w, 2, F.greatest(n - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
        hits = F.filter(F.transform(pairs, lambda g, i: F.struct(g.alias("g"), i.alias("i"))), lambda h: h["g"].isin(sorted(anchors)))
        placed = F.array_distinct(F.flatten(F.transform(hits, lambda h: F.transform(F.element_at(starts, h["g"]), lambda a: F.struct(a["k"].alias("k"), (h["i"] - a["o"]).alias("s"))))))

        def scored(c):
            size = F.element_at(sizes, c["k"] + 1)
            begin, end = F.greatest(c["s"], F.lit(0)), F.least(c["s"] + size, n)

            def compared(said):
                own, mine = F.element_at(grams, c["k"] + 1), _bigrams(said)
                shared = F.size(F.array_intersect(mine, own))
                ok = agrees(said, c["k"]) if agrees else F.lit(True)
                dice = 2.0 * shared / (F.size(mine) + F.size(own))
                dice = F.when((dice >= threshold) & ok, dice).otherwise(0.0)
                return F.struct(shared.alias("shared"), dice.alias("dice"), F.element_at(names, c["k"] + 1).alias("licence"), F.element_at(families, c["k"] + 1).alias("family"), begin.alias("begin"), end.alias("end"), F.array_join(said, " ").alias("said"))

            return _let(F.slice(w, begin + 1, end - begin), compared)

        def rank(m):
            return F.struct(m["shared"], m["dice"], m["licence"], -m["begin"])

        reached = F.filter(F.transform(placed, scored), lambda m: m["dice"] >= threshold)
        return _let(reached, lambda every: F.filter(every, lambda m: ~F.exists(every, lambda o: (o["begin"] < m["end"]) & (m["begin"] < o["end"]) & (rank(o) > rank(m)))))

    kept = _let(words, found)
    return F.transform(kept, lambda m: F.struct(m["dice"].alias("dice"), m["licence"].alias("licence"), m["family"].alias("family"), m["said"].alias("said")))


def licences(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", notices: dict[str, tuple[str, str]] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """Per input row: id, ``licence``, ``family``, ``dice`` (null without one), ``n_passages`` that match any."""
    notices = notices or NOTICES
    listed = [(name, family, bigrams_of(text)) for name, (family, text) in notices.items()]
    bare = {name: re.sub("[^a-z0-9.]+", " ", undotted(text)).strip(" ").split(" ") for name, (_, text) in notices.items()}
    sought = [(name, family, bigrams_of(" ".join(bare[name])), len(bare[name])) for name, (family, _) in notices.items()]
    low, high = threshold / (2 - threshold), (2 - threshold) / threshold
    fewest, most = min(len(b) for *_, b in listed) * low, max(len(b) for *_, b in listed) * high

    limits = {name: terms_of(words) for name, words in bare.items()}
    every_term, every_version = (F.array(*[_texts(limits[name][i]) for name in notices]) for i in (0, 1))

    def agrees(words, k):
        return _agrees(words, F.element_at(every_term, k + 1), F.element_at(every_version, k + 1))

    names, families, every = _texts([x[0] for x in listed]), _texts([x[1] for x in listed]), F.array(*[_texts(x[2]) for x in listed])
    numbers = F.array(*[F.lit(k) for k in range(len(listed))])

    def best(words):
        return _let(_bigrams(words), lambda grams: F.when(F.size(grams).between(fewest, most), against(words, grams)))

    def against(words, grams):
        n = F.size(grams)

        def tried(k):
            own = F.element_at(every, k + 1)
            fits = n.between(low * F.size(own), high * F.size(own))
            dice = F.when(fits, 2.0 * F.size(F.array_intersect(grams, own)) / (n + F.size(own))).otherwise(0.0)
            return F.struct(dice.alias("dice"), F.element_at(names, k + 1).alias("licence"), F.element_at(families, k + 1).alias("family"), k.alias("k"))

        reached = F.filter(F.transform(numbers, tried), lambda m: m["dice"] >= threshold)
        return F.array_max(F.filter(reached, lambda m: agrees(words, m["k"])))

    picked = telling([own for *_, own, _ in sought], threshold)
    anchors: dict[str, list[tuple[int, int]]] = {}
    for k, (name, *_) in enumerate(sought):
        for o, g in enumerate(zip(bare[name], bare[name][1:])):
            if " ".join(g) in picked:
                anchors.setdefault(" ".join(g), []).append((k, o))
    grams = sorted({undotted(g) for g in telling([own for *_, own in listed], threshold)} | set(picked))
    told = (r"\.*+[^a-z0-9.]++".join(map(re.escape, g.split(" "))) + r"\.*+" for g in grams)
    first = "|".join(sorted({re.escape(g[0]) for g in grams}))
    needed = f"(?<![a-z0-9.])(?={first})(?:{'|'.join(told)})(?![a-z0-9.])"
    rows = df.select(F.col(id_col), F.translate(text_col, UPPER, LOWER).alias("__t"))
    rows = rows.select(id_col, F.when(F.col("__t").rlike(needed), F.regexp_replace("__t", "[^a-z0-9.\n]+", " ")).alias("__n"))
    none = F.array().cast("array<struct<dice:double,licence:string,family:string,said:string>>")
    bared = F.regexp_replace(F.trim(F.regexp_replace("__n", "[ \n]+", " ")), r"\.+(?= |$)", "")

    def own(p):
        return _let(best(F.split(p, " ")), lambda m: F.struct(m["dice"].alias("dice"), m["licence"].alias("licence"), m["family"].alias("family"), F.regexp_replace(p, r"\.+(?= |$)", "").alias("said")))

    matched = F.filter(F.transform(passages(F.col("__n"), needed), own), lambda m: m["dice"] >= threshold)
    rows = rows.select(
        id_col,
        F.coalesce(F.when(F.col("__n").isNotNull(), matched), none).alias("__m"),
        F.coalesce(F.when(F.col("__n").isNotNull(), windows(F.filter(F.split(bared, " "), lambda x: x != ""), sought, anchors, threshold, agrees)), none).alias("__w"),
    )
    # Of a passage and a window of which one holds the other, the longer one.
    left = F.filter("__m", lambda m: ~F.exists("__w", lambda w: _spans(w).contains(_spans(m)) & (F.length(w["said"]) > F.length(m["said"]))))
    more = F.filter("__w", lambda w: ~F.exists("__m", lambda m: _spans(m).contains(_spans(w))))
    found = rows.select(id_col, F.concat(left, F.array_distinct(more)).alias("__m")).select(id_col, F.array_max("__m").alias("__b"), F.size("__m").cast("bigint").alias("n_passages"))
    return found.select(id_col, F.col("__b.licence").alias("licence"), F.col("__b.family").alias("family"), F.col("__b.dice").alias("dice"), "n_passages")
