"""Licence families of paragraphs: a trained classifier, confirmed by templates."""

from __future__ import annotations

import re
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame, functions as F

from .common import rows_of

UNKNOWN = "unknown"
# Usual notices of each family.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "This project is released under the Apache License 2.0.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or any later version.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ],
    "bsd-3-clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "proprietary": [
        "All rights reserved.",
        "Copyright. All rights reserved. No part of this work may be reproduced without permission.",
    ],
}
# Sentences that talk of licences or use their words without granting one.
OTHERS = [
    "The driver showed a license to the officer and drove on.",
    "The version of the story that was released is not the work of the public.",
    "You may use the general terms under the following conditions.",
    "The license of the shop was revoked without permission.",
    "The rights of the people are reserved for the free.",
    "A copy of the work was released in the first version.",
    "The software was used by the general public under pressure.",
    "All of the files were modified and met the terms.",
    "Sie fuhr mit dem Zug und kam mit dem Bus.",
    "Er sprach mit der Frau und ging mit dem Hund nach Hause.",
    "Das Haus mit dem Garten steht am See.",
    "Mit Wasser und Brot kamen sie durch den Winter.",
    "Kommst du mit.",
    "Er geht mit.",
    "Alle machen mit.",
]
# Notices of licences that are none of the families.
OTHER_LICENSES = [
    "This work is licensed under the GNU General Public License, version 2 only.",
    "This program is distributed under the GNU General Public License, Version 2.",
    "SPDX-License-Identifier: GPL-2.0-only",
    "Licensed under the GNU Lesser General Public License, version 3.",
    "SPDX-License-Identifier: LGPL-2.1-or-later",
    "Licensed under the GNU Affero General Public License, version 3.",
    "SPDX-License-Identifier: AGPL-3.0-only",
    "This project is released under the BSD 2-Clause License.",
    "SPDX-License-Identifier: BSD-2-Clause",
    "Licensed under the BSD 4-Clause License.",
    "This work is licensed under CC BY 4.0.",
    "Licensed under CC BY-SA 4.0.",
    "Licensed under CC BY-NC-ND 4.0.",
    "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "Licensed under the Mozilla Public License, version 2.0.",
    "SPDX-License-Identifier: MPL-2.0",
    "Licensed under the Apache License, Version 1.1.",
    "Released under the ISC License.",
    "SPDX-License-Identifier: MIT-0",
    "Released into the public domain.",
    "Some rights reserved.",
]
# Further notices of the families, for training only: they set off the rows
# above, and do not confirm.
WORDINGS = {
    "apache-2.0": ["Licensed under Apache License v2.0."],
    "mit": ["The code is available under the MIT License."],
    "gpl-3.0": [
        "Licensed under GPL-3.0.",
        "Distributed under the terms of the GNU General Public License version 3.",
        "SPDX-License-Identifier: GPL-3.0",
    ],
    "bsd-3-clause": ["Distributed under the BSD 3-Clause License."],
    "cc-by-nc-4.0": ["The text is licensed under CC BY-NC 4.0."],
    "proprietary": ["Copyright by the authors, all rights reserved."],
}
# Rows that training does not see. Temperature and least share come from them.
HELD_OUT = {
    "apache-2.0": [
        "This software is licensed under the Apache License, Version 2.0.",
        "Distributed under the Apache License 2.0.",
        "Released under Apache-2.0.",
    ],
    "mit": [
        "This project is licensed under the MIT License.",
        "Distributed under the MIT License.",
        "MIT License",
    ],
    "gpl-3.0": [
        "This program is licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License version 3 or later.",
        "SPDX-License-Identifier: GPL-3.0-only",
    ],
    "bsd-3-clause": [
        "Licensed under the BSD 3-Clause License.",
        "This project is released under the BSD 3-Clause License.",
    ],
    "cc-by-nc-4.0": [
        "This work is licensed under CC BY-NC 4.0.",
        "Released under a Creative Commons Attribution-NonCommercial 4.0 License.",
    ],
    "proprietary": [
        "Copyright Example Corporation. All rights reserved.",
        "All rights reserved worldwide.",
    ],
    UNKNOWN: [
        "This work is licensed under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-2.0-or-later",
        "Released under the GNU Lesser General Public License, version 2.1.",
        "Released under the BSD 2-Clause License.",
        "Licensed under the BSD 2-Clause License.",
        "Licensed under CC BY 4.0.",
        "Released under CC BY-SA 4.0.",
        "Released under a Creative Commons Attribution 4.0 License.",
        "Released under the Mozilla Public License 2.0.",
        "Licensed under the ISC License.",
        "No rights reserved.",
        "He lost his license.",
        "The new version of the program was free of charge.",
        "Many conditions were met by the source of the river.",
        "Sie kam mit.",
        "Wir nehmen dich mit.",
        "Mit.",
        "Der Mann mit dem Hut lief durch die Stadt.",
        "Er schrieb mit der linken Hand.",
    ],
}
# What a line's words must hold, and must not hold, for a family to be told
# from its neighbours: version, number of clauses, non-commercial and no more. The
# redistribution line of BSD licences is common to all of them and tells none.
TELLING = {
    "apache-2.0": (
        " apache (?:software )?(?:licen[cs]e )?(?:version |v )?v?2 (?:0 |(?![0-9]))",
        " apache (?:software )?(?:licen[cs]e )?(?:version |v )?v?1 ",
    ),
    "mit": (
        " mit licen[cs]e | licen[cs]e identifier mit | licen[cs]ed under mit "
        "| permission is hereby granted free of charge to any person obtaining a copy of this software ",
        " mit 0 | mit no attribution ",
    ),
    "gpl-3.0": (
        " (?:general public licen[cs]e|gpl) (?:as published by the free software foundation )?"
        "(?:either )?(?:version |v )?v?3 (?:0 |(?![0-9]))| gplv3 ",
        " lesser | library | affero | lgpl| agpl| gplv2 | (?:version|v|gpl|licen[cs]e) v?[12] ",
    ),
    "bsd-3-clause": (
        " bsd (?:3|three) clause | (?:3|three) clause bsd ",
        " (?:[0124]|zero|one|two|four) clause | clause (?:clear|attribution|lbnl|modification|no|open) ",
    ),
    "cc-by-nc-4.0": (
        " (?:cc by nc|attribution non ?commercial) (?:version |v )?v?4 (?:0 |(?![0-9]))",
        " sa | nd | share ?alike | no ?deriv(?:s|ative|atives) ",
    ),
    "proprietary": (" all rights reserved ", " not all rights reserved "),
}
# Function words. A gram of these alone is no feature.
STOP_WORDS = [
    "a", "all", "and", "any", "are", "as", "be", "by", "can", "either", "except", "for",
    "in", "is", "it", "later", "may", "no", "not", "of", "on", "or", "that", "the",
    "this", "to", "under", "was", "were", "with", "without", "you",
]
_WORD = "[0-9a-z]+"
# Share of a paragraph's bigrams in the family's templates that confirms a prediction.
LEAST_OVERLAP = 0.5


def _features(text: str) -> list[str]:
    words = re.findall(_WORD, text.lower())
    grams = {*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))}
    return sorted(g for g in grams if not set(g.split()) <= set(STOP_WORDS))


def train(rounds: int = 2000, rate: float = 0.1, decay: float = 1e-3) -> tuple[list[str], dict[str, np.ndarray], np.ndarray, float]:
    """Multinomial logistic regression on word 1- and 2-grams of the fixed rows.

    The sample is the constants above: this is the bound. Weights and biases are learned
    from ``TEMPLATES``, ``WORDINGS``, ``OTHERS`` and ``OTHER_LICENSES``; ``HELD_OUT`` then
    gives the temperature, which both are divided by, and the least share. Returns the classes
    (unknown last), weights by gram, the biases and the least share.
    """
    classes = [*TEMPLATES, UNKNOWN]
    rows = [(t, i) for i, c in enumerate(TEMPLATES) for t in TEMPLATES[c] + WORDINGS[c]]
    rows += [(t, len(classes) - 1) for t in OTHERS + OTHER_LICENSES]
    grams = sorted({g for t, _ in rows for g in _features(t)})
    place = {g: i for i, g in enumerate(grams)}

    def vectors(texts: list[str]) -> np.ndarray:
        x = np.zeros((len(texts), len(grams)))
        for i, t in enumerate(texts):
            found = _features(t)
            x[i, [place[g] for g in found if g in place]] = 1 / np.sqrt(max(len(found), 1))
        return x

    x = vectors([t for t, _ in rows])
    y = np.eye(len(classes))[[c for _, c in rows]]
    weights, bias = np.zeros((len(grams), len(classes))), np.zeros(len(classes))
    for _ in range(rounds):
        wrong = _softmax(x @ weights + bias) - y
        weights -= rate * (x.T @ wrong + decay * weights)
        bias -= rate * wrong.mean(axis=0)
    held = [(t, classes.index(c)) for c in HELD_OUT for t in HELD_OUT[c]]
    truth = np.array([c for _, c in held])
    temperature, least = _calibrated(vectors([t for t, _ in held]) @ weights + bias, truth)
    return classes, {g: weights[i] / temperature for g, i in place.items()}, bias / temperature, least


def _softmax(z: np.ndarray) -> np.ndarray:
    p = np.exp(z - z.max(axis=1, keepdims=True))
    return p / p.sum(axis=1, keepdims=True)


def _calibrated(z: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Temperature of least log loss, then the share that decides most held-out rows right.

    Not below one half, so that a family has to outweigh unknown; of equally good shares
    the middle one.
    """
    at = np.arange(len(truth))
    temperatures = np.geomspace(0.1, 10, 201)
    losses = [-np.log(_softmax(z / t)[at, truth]).mean() for t in temperatures]
    temperature = float(temperatures[int(np.argmin(losses))])
    families = _softmax(z / temperature)[:, :-1]
    shares = np.arange(0.5, 1, 0.01)
    unknown = z.shape[1] - 1
    right = [(np.where(families.max(axis=1) >= s, families.argmax(axis=1), unknown) == truth).sum() for s in shares]
    best = shares[np.array(right) == max(right)]
    return temperature, float(best[len(best) // 2])


def license_paragraphs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Paragraphs (lines) that the classifier gives to a licence family.

    Native expressions only. Every feature holds a word of the templates that is no
    function word; lines with none of those words have no feature, are unknown and end in
    the scan. The others' word 1- and 2-grams meet the classifier's weights, a table of a
    few hundred fixed rows; the sums per line give a softmax, and a line below the
    calibrated share is unknown and left out. ``confirmed`` says that the line holds the
    family's ``TELLING`` words and none of its neighbours', and that at least
    ``LEAST_OVERLAP`` of its bigrams stand in the family's templates;
    a line without bigrams is never confirmed.

    Returns ``doc_id``, ``line`` (number in the text), ``family``, ``share``,
    ``confirmed``. Null and empty texts have no lines; null ids and repeated rows keep
    rows of their own; other columns are not read.
    """
    spark = docs.sparkSession
    classes, weights, bias, least_share = train()
    # As unknown has the largest bias, a line scores more for a family only by a feature
    # that does, so it holds a word of such a feature.
    assert bias[-1] == bias.max()
    lifting = (g for g, w in weights.items() if w[:-1].max() > w[-1])
    cues = sorted({word for g in lifting for word in g.split()} - set(STOP_WORDS))
    table = [
        (g, [float(v) for v in w], [c for c in TEMPLATES if any(g in _features(t) for t in TEMPLATES[c])])
        for g, w in weights.items()
    ]
    table = spark.createDataFrame(table, "gram string, weights array<double>, families array<string>")
    plain = rows_of(docs, id_col, text_col).toDF("doc_id", "text").filter("text IS NOT NULL")
    # The class of first letters only spares the attempts of all words.
    first = "".join(sorted({word[0] for word in cues}))
    pattern = f"(?<![0-9a-z])(?=[{first}])(?:{'|'.join(cues)})(?![0-9a-z])"
    lines = plain.select(
        F.monotonically_increasing_id().alias("rid"), "doc_id", F.posexplode(F.split("text", "\n")).alias("line", "text")
    )
    lines = lines.filter(F.lower("text").rlike(pattern))
    words = F.regexp_extract_all(F.lower("text"), F.lit(_WORD), F.lit(0))
    lines = lines.select("rid", "doc_id", F.col("line").cast("long").alias("line"), words.alias("words"))
    spaced = F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))
    told = [spaced.rlike(must) & ~spaced.rlike(never) for must, never in (TELLING[c] for c in TEMPLATES)]
    told = [F.when(t, 1 << i).otherwise(0) for i, t in enumerate(told)]
    lines = lines.withColumn("told", reduce(lambda a, b: a + b, told))
    # As in training, grams of function words alone do not count. The last word has no
    # partner: its pair is null and goes too.
    stop = "|".join(STOP_WORDS)
    following = F.slice("words", F.lit(2), F.size("words"))
    pairs = F.zip_with("words", following, lambda a, b: F.concat(a, F.lit(" "), b))
    pairs = F.filter(pairs, lambda pair: ~pair.rlike(f"^(?:{stop}) (?:{stop})$"))
    lines = lines.withColumn("pairs", F.array_distinct(pairs))
    single = F.array_except("words", F.array(*map(F.lit, STOP_WORDS)))
    grams = lines.withColumn("all", F.concat(single, "pairs"))
    rows = grams.select(
        "rid", "doc_id", "line", "told", F.size("all").alias("n"), F.size("pairs").alias("m"), F.explode("all").alias("gram")
    ).join(F.broadcast(table), "gram")
    sums = [F.sum(F.col("weights")[i]).alias(f"w{i}") for i in range(len(classes))]
    hits = [F.count(F.when(F.array_contains("families", c) & F.col("gram").contains(" "), 1)).alias(f"h{i}") for i, c in enumerate(TEMPLATES)]
    scored = rows.groupBy("rid", "doc_id", "line", "told", "n", "m").agg(*sums, *hits)
    odds = [F.exp(F.col(f"w{i}") / F.sqrt("n") + float(bias[i])) for i in range(len(classes))]
    total = reduce(lambda a, b: a + b, odds)
    confirmed = [
        (F.col("told").bitwiseAND(F.lit(1 << i)) != 0) & (F.col("m") > 0) & (F.col(f"h{i}") >= LEAST_OVERLAP * F.col("m"))
        for i in range(len(TEMPLATES))
    ]
    options = F.array(
        *(
            F.struct((odds[i] / total).alias("share"), F.lit(c).alias("family"), confirmed[i].alias("confirmed"))
            for i, c in enumerate(TEMPLATES)
        )
    )
    best = scored.select("doc_id", "line", F.array_max(options).alias("b"))
    return best.filter(F.col("b.share") >= least_share).select("doc_id", "line", "b.family", "b.share", "b.confirmed")
