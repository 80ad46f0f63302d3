import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from quern.llm import chat_format, license_scan, quality_rules

SPACE = re.compile(r"[^\x20\x09-\x0D]+")
TEXT = "key long, words string, text string, n_words string, _h1 int"


def brute(text):
    text = text or ""
    words = SPACE.findall(text)
    seen, covered = {}, set()
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    for places in seen.values():
        if len(places) > 1:
            covered |= {p + k for p in places for k in range(8)}
    lines = [x for x in text.split("\n") if SPACE.search(x)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), text.count("!"), len(lines),
        len(lines) - len(set(lines)), len(covered),
    )


def texts():
    rng = random.Random(3)
    some = [" ".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(60)]
    some += ["\n".join(rng.choice(["x y", "", "\t", "z"]) for _ in range(9)) for _ in range(5)]
    some += [None, "", " \t\n", "é ü 日本 🎉 #$", "w " * 5000, "a b \x1c c", "same line\nsame line\n \n same line"]
    return some + some[:2]


def test_measures_against_brute_force(spark):
    rows = [(i if i % 9 else None, "clash", t, "x", 1) for i, t in enumerate(texts())]
    got = quality_rules.measure(spark.createDataFrame(rows, TEXT), "key").collect()
    want = sorted(((k, *brute(t)) for k, _, t, _, _ in rows), key=str)
    assert sorted(map(tuple, got), key=str) == want


def test_policies_and_ablations_use_bits_only(spark):
    entries = quality_rules.ledger(spark.createDataFrame([(i, "c", t, "x", 1) for i, t in enumerate(texts())], TEXT), "key")
    bits = [r["failed_bits"] for r in entries.collect()]
    only = entries.select("failed_bits")
    policy = quality_rules.POLICIES["v1"]
    mask = quality_rules.mask_of(policy)
    got = {r["rule"]: r for r in quality_rules.ablations(only, policy).collect()}
    assert set(got) == set(policy)
    for rule in quality_rules.RULES[: len(policy)]:
        one = 1 << rule.bit
        r = got[rule.name]
        assert r["n_failed"] == sum(bool(b & one) for b in bits)
        assert r["n_only"] == sum((b & mask) == one for b in bits)
        assert r["n_kept_without"] == sum(not b & mask & ~one for b in bits)
        assert r["n_kept"] == sum(not b & mask for b in bits)
    kept = quality_rules.apply_policies(only).where("kept_v2").count()
    assert kept == sum(not b & quality_rules.mask_of(quality_rules.POLICIES["v2"]) for b in bits)
    assert quality_rules.ablations(only.limit(0), policy).count() == len(policy)


def test_ledger_of_no_rows(spark):
    none = spark.createDataFrame([], TEXT)
    assert quality_rules.ledger(none, "key").count() == 0
    assert chat_format.format_chats(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0
    assert license_scan.scan_licenses(none, "key").count() == 0


PARTS = ["</turn>", "### ", "\\", ": ", "\n", "a", " ", "<", "/turn>", "###", "user", "\n### assistant: ", "é", "</tu", "rn>", "$1", "🎉"]


@pytest.fixture(scope="module")
def chats():
    rng = random.Random(5)
    rows = []
    for c in range(60):
        for turn in range(rng.randint(1, 6)):
            text = "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 8)))
            role = rng.choice(["user", "assistant", "system", "odd: role", "user:x", "a:", ":", "x\\", "</turn>", "\n### x", None])
            rows.append((c if c else None, turn if rng.random() < 0.9 else None, role, rng.choice([text, text, None])))
    rows += [(99, 0, "user", "same"), (99, 0, "user", "same"), (99, 0, "assistant", "long " * 4000)]
    return rows


def test_chats_come_back_and_masks_cover_the_assistant(spark, chats):
    df = spark.createDataFrame(chats, "conv_id long, turn long, role string, text string")
    formatted = chat_format.format_chats(df)
    got = {r["conv_id"]: r for r in chat_format.read_back(formatted).collect()}
    want = {}
    for conv, turn, role, text in chats:
        want.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert set(got) == set(want)
    for conv, turns in want.items():
        turns.sort()
        r = got[conv]
        assert [(t["role"], t["text"]) for t in r["turns"]] == [(a, b) for _, _, a, b in turns]
        assert r["loss_texts"] == [b for _, _, a, b in turns if a == "assistant" and b]
        # The mask alone, applied to the characters, finds the same texts.
        at, cut = 0, []
        for m in r["loss_mask"]:
            at += m["skip"]
            cut.append(r["formatted"][at : at + m["take"]])
            at += m["take"]
        assert [re.sub(r"(?s)\\(.)", r"\1", c) for c in cut if c] == r["loss_texts"]


def test_only_conflicting_turns_are_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "plain ### text: x"), (1, 1, "assistant", "a </turn> b")], "conv_id long, turn long, role string, text string")
    text = chat_format.format_chats(df).first()["formatted"]
    assert text == "### user: plain ### text: x</turn>\n### assistant: a <\\/turn> b</turn>"
    digest = hashlib.sha256(b"a </turn> b").hexdigest()
    assert chat_format.read_back(chat_format.format_chats(df)).select(F.sha2(F.col("loss_texts")[0], 256)).first()[0] == digest


def test_licences_need_their_sentences_in_order(spark):
    grant, condition, warranty = (k for k, v in license_scan.SENTENCES.items() if v in ("mit_grant", "mit_condition", "mit_warranty"))
    rows = [
        (1, f"MIT License\n\nCopyright (c) X. {grant.capitalize()}: {condition}. Other words here. {warranty}."),
        (2, f"{warranty}. {condition}. {grant}."),
        (3, "Text.\nLicensed under CC BY-NC 4.0.\nMore. Released under the MIT License.\n"),
        (4, None), (None, ""), (4, "Licensed under the Apache License, Version 2.0.\n"), (5, "x " * 20000),
    ]
    got = sorted((str(r["doc_id"]), r["licenses"]) for r in license_scan.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [("1", ["MIT"]), ("2", []), ("3", ["CC-BY-NC-4.0", "MIT"]), ("4", []), ("4", ["Apache-2.0"]), ("5", []), ("None", [])]


APACHE = """Copyright 2020 X

{0}Licensed under the Apache License, Version 2.0 (the "License");
{0}you may not use this file except in compliance with the License.
{0}You may obtain a copy of the License at
{0}
{0}    http://www.apache.org/licenses/LICENSE-2.0
{0}
{0}Unless required by applicable law or agreed to in writing, software
"""


def test_licence_lines_and_full_texts(spark):
    gpl = "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public License as published by\nthe Free Software Foundation, either version 3 of the License, or\n(at your option) any later version.\n"
    want = [
        ("words enerach\nAll rights reserved.", ["all-rights-reserved"]), ("from from\nLicensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0"]),
        ("thonhare.***\r\nLicensed under CC BY-NC 4.0\r\nmore", ["CC-BY-NC-4.0"]), (APACHE.format(""), ["Apache-2.0"]), (APACHE.format("# "), ["Apache-2.0"]),
        ("Apache License\n    Version 2.0, January 2004\n  http://www.apache.org/licenses/", ["Apache-2.0"]), (gpl, ["GPL-3.0"]),
        ("GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991\n\nCopyright (C) 1989\nEveryone is permitted to copy and distribute verbatim copies\nof this license document, but changing it is not allowed.", ["GPL-2.0"]),
        ("a\nThis project is licensed under the terms of the MIT license", ["MIT"]), ("This work is licensed under a Creative Commons Attribution 4.0 International License.", ["CC-BY-4.0"]),
        ("we hold that all rights reserved are void", []), ("nothing here", []),
    ]
    rows = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(want)], "doc_id long, text string")
    assert [r["licenses"] for r in license_scan.scan_licenses(rows).orderBy("doc_id").collect()] == [x for _, x in want]


def test_licence_lines_of_the_tables_are_all_found(spark):
    """Lines are searched for the wordings without the sentence rule of the scan."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    names = {"all rights reserved": "all-rights-reserved", "licensed under cc by nc 4 0": "CC-BY-NC-4.0", "released under the mit license": "MIT"}
    got, planted = {r["doc_id"]: r["licenses"] for r in license_scan.scan_licenses(docs).collect()}, 0
    for r in docs.collect():
        for line in (r["text"] or "").split("\n"):
            name = names.get(re.sub("[^a-z0-9]+", " ", line.lower()).strip())
            planted += name is not None
            assert name is None or name in got[r["doc_id"]], r["doc_id"]
    assert planted
