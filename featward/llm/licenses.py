"""Licence scan: known licence sentences, then ordered rules over the sequence of their ids."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licences and notices, and the rules that read them.
SENTENCES = {
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "This project is licensed under the MIT License.",
    "mit-title": "The MIT License (MIT)",
    "mit-name": "MIT License",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "apache-licensed": "Licensed under the Apache License, Version 2.0.",
    "apache-notice": "Licensed under the Apache License, Version 2.0 (the \"License\");",
    "apache-notice-use": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-use": "you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-title": "Apache License",
    "apache-version": "Version 2.0, January 2004",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-title": "GNU GENERAL PUBLIC LICENSE",
    "gpl-version-3": "Version 3, 29 June 2007",
    "gpl-version-2": "Version 2, June 1991",
    "lgpl-title": "GNU LESSER GENERAL PUBLIC LICENSE",
    "mpl-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "cc-by-4": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work.",
    "unlicense": "This is free and unencumbered software released into the public domain.",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache-2": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl-3": "SPDX-License-Identifier: GPL-3.0-or-later",
    "spdx-bsd-3": "SPDX-License-Identifier: BSD-3-Clause",
    "spdx-mpl-2": "SPDX-License-Identifier: MPL-2.0",
}

# In order: an earlier rule takes its sentences before a later one looks.
RULES = (
    ("MIT", ("mit-title", "mit-grant", "mit-notice")),
    ("MIT", ("mit-name", "mit-grant", "mit-notice")),
    ("MIT", ("mit-grant", "mit-notice")),
    ("Apache-2.0", ("apache-notice", "apache-use", "apache-copy")),
    ("Apache-2.0", ("apache-notice-use", "apache-copy")),
    ("Apache-2.0", ("apache-title", "apache-version")),
    ("GPL-3.0", ("gpl-title", "gpl-version-3")),
    ("GPL-2.0", ("gpl-title", "gpl-version-2")),
    ("LGPL-3.0", ("lgpl-title", "gpl-version-3")),
    ("BSD-3-Clause", ("bsd-redistribution", "bsd-endorse")),
    ("BSD-2-Clause", ("bsd-redistribution",)),
    ("MIT", ("mit-released",)),
    ("MIT", ("mit-licensed",)),
    ("MIT", ("spdx-mit",)),
    ("MIT", ("mit-grant",)),
    ("MIT", ("mit-title",)),
    ("MIT", ("mit-name",)),
    ("Apache-2.0", ("apache-licensed",)),
    ("Apache-2.0", ("apache-notice",)),
    ("Apache-2.0", ("apache-notice-use",)),
    ("Apache-2.0", ("spdx-apache-2",)),
    ("GPL-3.0", ("gpl3-work",)),
    ("GPL-3.0", ("gpl-free",)),
    ("GPL-3.0", ("spdx-gpl-3",)),
    ("BSD-3-Clause", ("spdx-bsd-3",)),
    ("MPL-2.0", ("mpl-form",)),
    ("MPL-2.0", ("spdx-mpl-2",)),
    ("ISC", ("isc-grant",)),
    ("CC-BY-SA-4.0", ("cc-by-sa-4",)),
    ("CC-BY-4.0", ("cc-by-4",)),
    ("CC0-1.0", ("cc0",)),
    ("Unlicense", ("unlicense",)),
)

# Short forms, titles and identifiers: each sentence alone names its licence.
_NAMED = (
    ("MIT", "mit", ("Licensed under MIT.", "Licensed under the MIT License.", "Released under MIT.")),
    (
        "Apache-2.0",
        "apache-2",
        (
            "Licensed under Apache 2.0.",
            "Licensed under Apache License 2.0.",
            "Licensed under the Apache License 2.0.",
            "Released under the Apache License, Version 2.0.",
            "Released under the Apache License 2.0.",
            "This project is licensed under the Apache License, Version 2.0.",
            "This project is licensed under the Apache License 2.0.",
        ),
    ),
    (
        "GPL-3.0",
        "gpl-3",
        (
            "Licensed under GPL 3.0.",
            "Licensed under GPLv3.",
            "Licensed under the GPLv3.",
            "Licensed under the GNU General Public License, version 3.",
            "Licensed under the GNU General Public License v3.0.",
            "Released under the GNU General Public License, version 3.",
            "This project is licensed under the GNU General Public License v3.0.",
            "SPDX-License-Identifier: GPL-3.0",
            "SPDX-License-Identifier: GPL-3.0-only",
        ),
    ),
    (
        "GPL-2.0",
        "gpl-2",
        (
            "Licensed under GPL 2.0.",
            "Licensed under GPLv2.",
            "Licensed under the GPLv2.",
            "Licensed under the GNU General Public License, version 2.",
            "This work is licensed under the GNU General Public License, version 2.",
            "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
            "SPDX-License-Identifier: GPL-2.0",
            "SPDX-License-Identifier: GPL-2.0-only",
            "SPDX-License-Identifier: GPL-2.0-or-later",
        ),
    ),
    (
        "LGPL-3.0",
        "lgpl-3",
        (
            "Licensed under LGPL 3.0.",
            "Licensed under the GNU Lesser General Public License, version 3.",
            "This work is licensed under the GNU Lesser General Public License, version 3.",
            "SPDX-License-Identifier: LGPL-3.0-only",
            "SPDX-License-Identifier: LGPL-3.0-or-later",
        ),
    ),
    (
        "LGPL-2.1",
        "lgpl-2-1",
        (
            "Licensed under LGPL 2.1.",
            "Licensed under the GNU Lesser General Public License, version 2.1.",
            "SPDX-License-Identifier: LGPL-2.1-only",
            "SPDX-License-Identifier: LGPL-2.1-or-later",
        ),
    ),
    (
        "AGPL-3.0",
        "agpl-3",
        (
            "Licensed under AGPL 3.0.",
            "Licensed under the GNU Affero General Public License, version 3.",
            "This work is licensed under the GNU Affero General Public License, version 3.",
            "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
            "SPDX-License-Identifier: AGPL-3.0-only",
            "SPDX-License-Identifier: AGPL-3.0-or-later",
        ),
    ),
    (
        "BSD-3-Clause",
        "bsd-3",
        (
            "BSD 3-Clause License",
            "Licensed under BSD 3-Clause.",
            "Licensed under the BSD 3-Clause License.",
            "Released under the BSD 3-Clause License.",
            "This project is licensed under the BSD 3-Clause License.",
        ),
    ),
    (
        "BSD-2-Clause",
        "bsd-2",
        (
            "BSD 2-Clause License",
            "Licensed under BSD 2-Clause.",
            "Licensed under the BSD 2-Clause License.",
            "Released under the BSD 2-Clause License.",
            "This project is licensed under the BSD 2-Clause License.",
            "SPDX-License-Identifier: BSD-2-Clause",
        ),
    ),
    (
        "ISC",
        "isc",
        (
            "Licensed under ISC.",
            "Licensed under the ISC License.",
            "Released under the ISC License.",
            "This project is licensed under the ISC License.",
            "SPDX-License-Identifier: ISC",
        ),
    ),
    (
        "MPL-2.0",
        "mpl-2",
        (
            "Mozilla Public License Version 2.0",
            "Licensed under MPL 2.0.",
            "Licensed under the Mozilla Public License, version 2.0.",
            "Released under the Mozilla Public License, version 2.0.",
        ),
    ),
    (
        "CC0-1.0",
        "cc0-1",
        (
            "CC0 1.0 Universal",
            "Licensed under CC0.",
            "Licensed under CC0 1.0.",
            "Released under CC0 1.0.",
            "This work is licensed under CC0 1.0.",
            "SPDX-License-Identifier: CC0-1.0",
        ),
    ),
    ("Unlicense", "unlicense", ("Released under the Unlicense.", "SPDX-License-Identifier: Unlicense")),
    *(
        (
            f"CC-{code}-{version}",
            f"cc-{code}-{version[0]}".lower(),
            (
                f"Licensed under CC {code} {version}.",
                f"Released under CC {code} {version}.",
                f"This work is licensed under CC {code} {version}.",
                f"This work is licensed under a Creative Commons {name} {version} {kind} License.",
                f"This work is licensed under the Creative Commons {name} {version} {kind} License.",
                f"Creative Commons {name} {version} {kind}",
                f"SPDX-License-Identifier: CC-{code}-{version}",
            ),
        )
        for version, kind in (("4.0", "International"), ("3.0", "Unported"))
        for code, name in (
            ("BY", "Attribution"),
            ("BY-SA", "Attribution-ShareAlike"),
            ("BY-NC", "Attribution-NonCommercial"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-ND", "Attribution-NoDerivatives"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
        )
    ),
)
_listed = set(SENTENCES.values())
for _licence, _id, _forms in _NAMED:
    for _n, _form in enumerate(_forms, 1):
        if _form not in _listed:
            SENTENCES[f"{_id}-form-{_n}"] = _form
            RULES += ((_licence, (f"{_id}-form-{_n}",)),)

SENTENCE_END = r"([.!?])[ \t\r]+([^a-z0-9 \t\r])"
INNER_END = r"([.!?])[ \t\r]+([^a-z0-9 \t\r\n])"  # within a line
LINE_END = r"([.!?])[^A-Za-z0-9\n]*\n[^A-Za-z0-9\n]*(?=[A-Z])"


def plain_sentence(sentence: str) -> str:
    runs = "".join(c if c.isascii() and c.isalnum() else " " for c in sentence).split()
    return " ".join(runs).lower()


def joined_lines(text: Column) -> Column:
    """The text with normalised lines: one line break may stand within a sentence, two may not.

    Two come of a sentence's end, by the same rule over a line's end, and of lines without an ASCII letter
    or digit; what marks a comment (``#``, ``*``, ``//``) goes with the other characters.
    """
    ended = F.regexp_replace(text, INNER_END, "$1\n\n$2")
    ended = F.regexp_replace(ended, LINE_END, "$1\n\n")
    plain = F.regexp_replace(ended, r"[^A-Za-z0-9\n]+", " ")
    return F.trim(F.lower(F.regexp_replace(plain, r" *\n *", "\n")))


def across_lines(plain: Sequence[str]) -> str:
    """A pattern of the normalised sentences in joined lines, of those that begin alike the shorter first."""
    bodies = [p.replace(" ", r"[ \n]") for p in sorted(plain, key=lambda p: (len(p.split()), p))]
    return rf"(?<![^\n])(?:{'|'.join(bodies)})(?![^\n])"


def anchor_words(plain: Sequence[str]) -> list[str]:
    """A few words such that each of the normalised sentences holds one; the longer, the better."""
    left, picked = [set(p.split()) for p in plain if p], []
    while left:
        best = max(
            {w for words in left for w in words},
            key=lambda w: (len(w) > 6, sum(w in words for words in left), len(w), w),  # long words are rare
        )
        picked.append(best)
        left = [words for words in left if best not in words]
    return picked


def scan_licenses(
    df: DataFrame,
    text_col: str = "text",
    known: Mapping[str, str] = SENTENCES,
    rules: Sequence[tuple[str, Sequence[str]]] = RULES,
) -> DataFrame:
    """The frame's rows with ``sentence_ids`` and ``licenses``.

    ``sentence_ids``: the ids of the text's known sentences in their order, repeats included; other
    sentences are passed over. ``licenses``: one entry for each time that a rule's whole id
    sequence occurs, without another known sentence between, by order of the rules. An earlier rule
    takes its sentences, and what it leaves on either side of them is not read as adjacent.

    ``known`` maps ids to sentences, ``rules`` are (licence, ids) in order; both are part of the
    expression, so they are meant to be some thousand entries at most. A NULL or empty text has two
    empty arrays. Only columns and built-in functions: no shuffle, one row in, one row out.
    Columns of the frame with these two names are replaced.

    A known sentence may be wrapped over lines, with or without comment marks, and is read from the start
    of a line or sentence to the end of one; blank lines and sentence marks end it. Of known sentences
    that begin together the shortest is taken, so one that fills a line is read as that line.

    Texts without any of a few anchor words are passed over before they are normalised; as every known
    sentence holds an anchor word, none is missed by it.
    """
    ids = {plain_sentence(sentence): name for name, sentence in known.items() if plain_sentence(sentence)}
    for name in known:
        if set("<>|") & set(name):
            raise ValueError(f"a sentence id may not hold <, > or |: {name!r}")
    wanted = F.create_map(*[F.lit(x) for pair in ids.items() for x in pair])
    none = F.array().cast("array<string>")
    if not ids:
        return df.withColumn("sentence_ids", none).withColumn("licenses", none)
    anchors = "(?i)" + "|".join(anchor_words(list(ids)))
    parts = F.regexp_extract_all(joined_lines(F.col(text_col)), F.lit(across_lines(list(ids))), F.lit(0))
    found = F.transform(parts, lambda s: F.try_element_at(wanted, F.translate(s, "\n", " ")))
    found = F.when(F.col(text_col).rlike(anchors), found).otherwise(none)
    if not rules:
        return df.withColumn("sentence_ids", found).withColumn("licenses", none)

    table = F.array(
        *[
            F.struct(F.lit(licence).alias("licence"), F.lit("".join(f"<{i}>" for i in seq)).alias("seq"))
            for licence, seq in rules
        ]
    )

    def take(state: Column, rule: Column) -> Column:
        pieces = F.split(state["left"], F.concat(F.lit(r"\Q"), rule["seq"], F.lit(r"\E")), -1)
        return F.struct(
            F.array_join(pieces, "|").alias("left"),
            F.concat(state["licenses"], F.array_repeat(rule["licence"], F.size(pieces) - 1)).alias("licenses"),
        )

    sequence = F.concat(F.lit("<"), F.array_join("sentence_ids", "><"), F.lit(">"))
    start = F.struct(sequence.alias("left"), none.alias("licenses"))
    read = F.aggregate(table, start, take)["licenses"]
    return df.withColumn("sentence_ids", found).withColumn(
        "licenses", F.when(F.size("sentence_ids") > 0, read).otherwise(none)
    )
