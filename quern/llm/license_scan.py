"""Licence recognition by sentences and ordered rules.

Each normalised sentence of a text is mapped to the identifier of a known licence sentence, if it is one.
The sequence of identifiers is then matched against rules, each an ordered list of identifiers between which
other sentences may stand. Unless asked otherwise, every line end may start and end a sentence, and a sentence may
run over several lines.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentences of public licence texts and notices, lower-cased, with one space for all other characters.
SENTENCES = {
    "released under the mit license": "mit_notice",
    "licensed under the mit license": "mit_notice",
    "mit license": "mit_title",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions "
    "of the software": "mit_condition",
    "the software is provided as is without warranty of any kind express or implied including but not limited to "
    "the warranties of merchantability fitness for a particular purpose and noninfringement": "mit_warranty",
    "licensed under the apache license version 2 0": "apache_notice",
    "licensed under the apache license version 2 0 the license": "apache_head",
    "you may not use this file except in compliance with the license": "apache_compliance",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache_copy",
    "apache license version 2 0 january 2004": "apache_title",
    "this work is licensed under the gnu general public license version 3": "gpl3_notice",
    "this work is licensed under the gnu general public license version 2": "gpl2_notice",
    "licensed under the gnu general public license version 3": "gpl3_notice",
    "licensed under the gnu general public license version 2": "gpl2_notice",
    "gnu general public license version 3 29 june 2007": "gpl3_title",
    "gnu general public license version 2 june 1991": "gpl2_title",
    "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not "
    "allowed": "gpl_verbatim",
    "licensed under cc by 4 0": "cc_by_notice",
    "licensed under cc by sa 4 0": "cc_by_sa_notice",
    "licensed under cc by nc 4 0": "cc_by_nc_notice",
    "licensed under cc by nd 4 0": "cc_by_nd_notice",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd_grant",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission": "bsd_names",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties "
    "including but not limited to the implied warranties of merchantability and fitness for a particular purpose are "
    "disclaimed": "bsd_warranty",
    "all rights reserved": "reserved",
}
# Rules in order of rank: where the sentences of one rule contain those of another, both are reported.
RULES = (
    ("MIT", ("mit_notice",)),
    ("MIT", ("mit_grant", "mit_condition", "mit_warranty")),
    ("Apache-2.0", ("apache_notice",)),
    ("Apache-2.0", ("apache_head", "apache_compliance", "apache_copy")),
    ("Apache-2.0", ("apache_title",)),
    ("GPL-3.0", ("gpl3_notice",)),
    ("GPL-3.0", ("gpl3_title", "gpl_verbatim")),
    ("GPL-2.0", ("gpl2_notice",)),
    ("GPL-2.0", ("gpl2_title", "gpl_verbatim")),
    ("CC-BY-4.0", ("cc_by_notice",)),
    ("CC-BY-SA-4.0", ("cc_by_sa_notice",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_notice",)),
    ("CC-BY-ND-4.0", ("cc_by_nd_notice",)),
    ("BSD-3-Clause", ("bsd_grant", "bsd_names", "bsd_warranty")),
    ("BSD-2-Clause", ("bsd_grant", "bsd_warranty")),
    ("all-rights-reserved", ("reserved",)),
)
RESTRICTED = ("GPL-3.0", "GPL-2.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "CC-BY-ND-4.0", "all-rights-reserved")
SENTENCE_END = r"[.!?;:][.!?;:)\"'\x5D]*\s+|[ \t]*\r?\n\s*\n\s*"
# Lead-ins of a notice, in normalised words; all are read as "licensed under".
LEAD_IN = (
    r"(?:(?:this|the|our|all)(?:[ |][a-z]+){1,3}[ |](?:is|are)[ |])?(?:made[ |])?"
    r"(?:licensed|released|distributed|published|available|provided)[ |]under[ |](?:the[ |]terms[ |]of[ |])?(?:the[ |]|a[ |])?"
)
_GPL = (
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the "
    "free software foundation either version {} of the license or at your option any later version"
)
_CC = {"attribution": "cc_by", "attribution sharealike": "cc_by_sa", "attribution noncommercial": "cc_by_nc", "attribution noderivatives": "cc_by_nd"}
# The sentences above and those by which full texts and file headers name the same licences.
ALL_SENTENCES = {
    **SENTENCES,
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "apache_copy",
    "licensed under the mit licence": "mit_notice",
    "licensed under the apache license 2 0": "apache_notice",
    _GPL.format(3): "gpl3_notice",
    _GPL.format(2): "gpl2_notice",
    **{f"creative commons {n} 4 0 international public license": f"{i}_notice" for n, i in _CC.items()},
    **{f"licensed under a creative commons {n} 4 0 international license": f"{i}_notice" for n, i in _CC.items()},
}


def normalise(sentence: Column) -> Column:
    """Lower-cased ASCII letters and digits, everything else one space."""
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def _sequence(text: Column, sentences: Mapping[str, str]) -> Column:
    known = F.create_map(*chain.from_iterable((F.lit(s), F.lit(i)) for s, i in sentences.items()))
    return F.transform(F.split(text, SENTENCE_END), lambda s: F.element_at(known, normalise(s)))


def _line_sequence(text: Column, sentences: Mapping[str, str]) -> Column:
    """Identifiers of the known sentences that start and end at a sentence or line end, in text order.

    Of two that start at one place the longer counts; after a sentence the search goes on behind it.
    """
    reduced = {re.sub("^" + LEAD_IN, "licensed under ", s): i for s, i in sentences.items()}
    known = F.create_map(*chain.from_iterable((F.lit(s), F.lit(i)) for s, i in reduced.items()))
    any_of = "|".join(s.replace(" ", "[ |]") for s in sorted(reduced, key=len, reverse=True))
    parts = F.transform(F.split(text, SENTENCE_END + r"|[\r\n]+"), normalise)
    # A bar stands for each end; normalised parts hold none.
    line = F.concat(F.lit("|"), F.array_join(F.filter(parts, lambda p: p != ""), "|"), F.lit("|"))
    line = F.regexp_replace(line, r"(?<=\|)" + LEAD_IN, "licensed under ")
    found = F.regexp_extract_all(line, F.lit(rf"(?<=\|)(?:{any_of})(?=\|)"), F.lit(0))
    return F.transform(found, lambda s: F.element_at(known, F.translate(s, "|", " ")))


def rule_pattern(ids: Sequence[str]) -> str:
    """Pattern over ``,a,b,c,`` that finds the identifiers in this order, with others between."""
    return "(?s)," + ",(?:.*,)?".join(ids) + ","


def scan_licenses(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    sentences: Mapping[str, str] = ALL_SENTENCES,
    rules: Sequence[tuple[str, Sequence[str]]] = RULES,
    lines: bool = True,
) -> DataFrame:
    """One row per row of ``docs``: ``key``, ``n_sentences``, ``sentence_ids`` in text order and sorted ``licenses``.

    Whole texts are read inside their rows and nothing is shuffled. A null or empty text has no sentences;
    repeated rows and null keys stay rows of their own; other columns are not read. The tables of sentences and
    rules are plan constants and should hold hundreds of entries, not millions. A sentence may start and end at
    a line break, run over line breaks and begin with any lead-in of a notice. With ``lines=False`` only an end
    mark or an empty line ends a sentence: one that lacks its end mark before a line break is not found.
    """
    d = docs.select(F.col(key), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    if lines:
        d = d.withColumn("_ids", F.split("_text", SENTENCE_END))
        d = d.withColumn("sentence_ids", _line_sequence(F.col("_text"), sentences))
    else:
        d = d.withColumn("_ids", _sequence(F.col("_text"), sentences))
        d = d.withColumn("sentence_ids", F.array_compact("_ids"))
    d = d.withColumn("_line", F.concat(F.lit(","), F.array_join("sentence_ids", ","), F.lit(",")))
    matched = F.array_compact(F.array(*[F.when(F.col("_line").rlike(rule_pattern(ids)), F.lit(name)) for name, ids in rules]))
    n = F.when(F.trim("_text") == "", 0).otherwise(F.size("_ids")).cast("long")
    return d.select(key, n.alias("n_sentences"), "sentence_ids", F.array_sort(F.array_distinct(matched)).alias("licenses"))
