"""Each operator on nulls, empty and odd texts, ties, repeated rows, empty
tables and extra columns with clashing names, and against plain versions."""

import hashlib
import itertools
import random
import math
import os
import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from changeflow.llm import bpe, chat, fitting, html_extract, licenses, mixing, ngram_join, quality_model, quality_rules, queries, toxicity, vafile
from changeflow.llm import textkernel as tk
from changeflow.llm.store import Scratch

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOW = {c: c + 32 for c in range(65, 91)}
#: Names that operators use inside.
CLASHES = ("id", "text2", "words", "size", "key", "bin", "score", "label", "n", "token", "a", "b", "digest", "_copy", "component_id", "taken", "rank", "lines", "host")


def odd_docs(spark, rows=None):
    rows = rows if rows is not None else [
        (1, "one two three four five six", "s"), (2, None, "s"), (3, "", None), (4, " \t\n ", "s"), (5, "Word", "t"), (5, "Word", "t"), (6, "é́  x \U0001f600", "t"),
        (7, "a b c d e f g h " * 40, "s"), (8, "x" * 50_000, "s"), (9, "line\nline\n\nline\nother", None), (None, "no id here at all, none", "t"), (10, "| # $ % & <x>", "s"),
    ]
    df = spark.createDataFrame([(i, t, s) for i, t, s in rows], "doc_id long, text string, source string")
    for c in CLASHES:
        df = df.withColumn(c, F.lit("clash"))
    return df


def texts(data):
    import pandas as pd

    return pd.read_parquet(f"{data}/documents.parquet")[["doc_id", "text", "source"]]


# words and shingles


def test_kernel_words():
    import pyarrow as pa

    draw = random.Random(1)
    found = ["".join(draw.choice(["a", "B", "é", " ", "\n", "\x0b", " ", "\U0001f600", "longer-than-eight-bytes"]) for _ in range(draw.randrange(30))) for _ in range(300)] + ["", None, " "]
    known: dict = {}
    for column in (pa.array(found), pa.array(found, pa.large_string()), pa.array(["x", *found])[1:]):
        at = 0
        for a, b, buf, offsets in tk.pieces(column, 200):
            assert a == at
            at = b
            starts, ends, first = tk.spans(buf, offsets)
            h = tk.hash_spans(buf, starts, ends)
            for i in range(a, b):
                words = WORD.findall(found[i] or "")
                own = slice(first[i - a], first[i - a + 1])
                assert [bytes(buf[s:e]).decode() for s, e in zip(starts[own], ends[own], strict=True)] == words
                for w, x in zip(words, h[own].tolist(), strict=True):
                    assert known.setdefault(w, x) == x
        assert at == len(found)
    assert len(set(known.values())) == len(known)


# 1 BPE


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.byte_bpe())


def test_bpe_equals_library(library):
    with open(queries.byte_bpe(), "rb") as f:
        v = bpe.Vocabulary(f.read())
    draw = random.Random(2)
    some = ["a", "b", " ", "  ", "\n", "é", "<|endoftext|>", "<|endo", "'s", "'LL", "՘", "\U0001f600", "\u0000", "１", "　", "ß", "x" * 40, "\t", "don't", "꟎", "한국어", "123 456"]
    odd = ["".join(draw.choice(some) for _ in range(draw.randrange(40))) for _ in range(1500)]
    odd += ["".join(chr(draw.choice([draw.randrange(0xD800), draw.randrange(0xE000, 0x110000)])) for _ in range(30)) for _ in range(500)]
    for x in odd:
        ids = library.encode(x, add_special_tokens=False).ids
        assert v.encode(x).tolist() == ids
        assert v.decode(ids) == library.decode(ids, skip_special_tokens=False)
    draw.shuffle(ids := list(range(50257)))
    assert v.decode(ids) == library.decode(ids, skip_special_tokens=False)  # any ids, also cut characters


def test_bpe_query(spark, data, library):
    found = {r.doc_id: r for r in queries.op1_bpe(spark, data).collect()}
    for d in texts(data).itertuples():
        ids = library.encode(d.text, add_special_tokens=False).ids
        r = found[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()


def test_bpe_odd(spark):
    docs = odd_docs(spark)
    out = bpe.transcode(docs, queries.byte_bpe())
    assert out.columns == ["doc_id", "ids", "decoded"]
    got = Counter((r.doc_id, r.decoded) for r in out.collect())
    assert got == Counter((r.doc_id, r.text or "") for r in docs.collect())
    (empty,) = bpe.digests(bpe.transcode(docs.filter("doc_id = 2"), queries.byte_bpe())).collect()
    assert (empty.n_tokens, empty.ids_sha256) == (0, hashlib.sha256(b"").hexdigest())
    assert bpe.transcode(docs.limit(0), queries.byte_bpe()).count() == 0


def test_bpe_repeated_rows(spark):
    rows = [(i, t) for i, t in enumerate(["a b", "a b", None, "", "a b", "c", "c", None, None, "c"])]
    got = {r.doc_id: r.decoded for r in bpe.transcode(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), queries.byte_bpe()).collect()}
    assert got == {i: t or "" for i, t in rows}


def test_bpe_memory():
    m = bpe._Memory(lambda w: (len(w),))
    limit, bpe.REMEMBERED = bpe.REMEMBERED, 3
    try:
        for w in ("a", "bb", "ccc", "dddd", "a", "x" * 100):
            assert m[w] == (len(w),)
    finally:
        bpe.REMEMBERED = limit
    assert len(m) <= 3 and "x" * 100 not in m
    with pytest.raises(ValueError, match="plain"):
        bpe.Vocabulary(b'{"model": {"type": "WordPiece", "vocab": {}}, "pre_tokenizer": {"type": "x"}, "added_tokens": []}')


# 2 Quotation linking


def messages(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    for c in ("lines", "conv", "msg", "root", "body", "hash", "level", "thread"):
        df = df.withColumn(c, F.lit("clash"))
    return df


def test_chat(spark):
    rows = [
        (1, 0, "u", "Hello there.\nHow are you today?"), (1, 1, "a", "> hello there.\n> How are  you today?\n\nFine thanks.\nAnd you?"),
        (1, 2, "u", "On Monday, X wrote:\n>> Hello there.\n>> How are you today?\n>\n> Fine thanks.\n> And you?\n\nGood."), (1, 3, "u", "unrelated\nHe wrote:\nno quote"),
        (1, 4, "a", "> Hello there. How are\n> you today?\nyes"), (2, 0, "u", "> Hello there.\nother conversation"), (2, 1, None, None), (2, 1, None, None), (None, None, "u", "> x"), (None, 1, "u", "y"), (None, 2, "a", "> y\nz"),
        (3, 0, "u", "same"), (3, 1, "u", "same"), (3, 600, "a", "> same\nlate"), (3, 601, "a", "> late\n> same\nboth"), (3, 5000, "a", "> both\nfar"),
    ]
    out = chat.link(messages(spark, rows))
    assert out.columns == ["conv_id", "turn", "role", "text", "reply_to", "thread", "n_passages", "n_linked"]
    got = out.collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    assert [by[1, t].reply_to for t in range(5)] == [None, 0, 1, None, 0] and [by[1, t].thread for t in range(5)] == [0, 0, 0, 3, 0]
    assert by[1, 2].text == "Good." and by[1, 1].text == "Fine thanks.\nAnd you?" and by[1, 3].text.endswith("no quote") and "wrote" in by[1, 3].text
    assert by[2, 0].reply_to is None and by[2, 0].n_passages == 1 and by[2, 0].n_linked == 0 and by[2, 1].text == ""
    assert by[None, 2].reply_to == 1 and by[None, None].reply_to is None
    # the latest of equal originals; most passages win, ties to the latest; threads over far turns
    assert (by[3, 600].reply_to, by[3, 601].reply_to, by[3, 5000].reply_to) == (1, 600, 601) and by[3, 5000].thread == 1
    assert [(r.conv_id, r.turn) for r in got if r.conv_id == 1] == [(1, 0), (1, 1), (1, 2), (1, 4), (1, 3)]
    assert chat.link(messages(spark, rows).limit(0)).count() == 0


def test_chat_long_chain(spark):
    n = 70
    rows = [(1, i, "u", (f"> body {i - 1} of the chain\n" if i else "") + f"body {i} of the chain") for i in range(n)]
    got = chat.link(messages(spark, rows)).collect()
    assert {r.thread for r in got} == {0} and [r.reply_to for r in got] == [None, *range(n - 1)]


def test_chat_equals_sql(spark):
    """Random conversations full of quotes, against the SQL."""
    import duckdb
    import pandas as pd

    draw = random.Random(9)
    said = ["yes", "no", "see the plan", "what of  it?", "", "  ", "A longer line of words", "X wrote:", "tab\there", "He writes :"]
    rows = []
    for conv in (1, 2, None):
        for turn in range(25):
            lines = []
            for _ in range(draw.randrange(7)):
                lines.append(draw.choice(["", "", "> ", ">", ">> ", "> > ", " >>>", ">" * draw.randrange(1, 40)]) + draw.choice(said) + draw.choice(["", "", "\r"]))
            rows.append((conv, turn if draw.random() < 0.95 else None, "u", "\n".join(lines) if draw.random() < 0.95 else None))
            if draw.random() < 0.1:
                rows.append(rows[-1])
    messages = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"]).astype({"conv_id": "Int64", "turn": "Int64"})
    con = duckdb.connect()
    con.register("conversations", messages)
    from ..test_catalogue import plain

    ours = chat.link(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).toPandas()
    theirs = con.execute(chat.oracle()).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert plain(ours.astype(object).where(ours.notna(), None)) == plain(theirs.astype(object).where(theirs.notna(), None))
    assert ours.n_linked.sum() > 50 and ours.reply_to.notna().sum() > 20


def test_chat_deep_quotes(spark):
    """A level for each of many lines, and a line of very many marks: only lines count."""
    import time

    body = [f"line {i} of it" for i in range(3000)]
    rows = [(1, 0, "u", "\n".join(body)), (1, 1, "a", "\n".join(">" * (i + 1) + x for i, x in enumerate(body)) + "\nyes"), (1, 2, "u", ">" * 200_000 + " yes\nno"), (1, 3, "a", "> " * 100_000 + "\nword " * 100_000)]
    begun = time.monotonic()
    got = {r.turn: r for r in chat.link(messages(spark, rows)).collect()}
    assert time.monotonic() - begun < 60
    assert [got[t].reply_to for t in range(4)] == [None, 0, 1, None] and got[1].n_linked == 3000 and got[2].text == "no"


def test_chat_query_keeps_messages(spark, data):
    out = queries.op2_chat_formatting(spark, data)
    assert out.count() == spark.read.parquet(f"{data}/conversations.parquet").count()


# 3 Quality rules


def plain_figures(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)


def test_quality_rules(spark, data):
    draw = random.Random(3)
    rows = [(i, " ".join(draw.choice("abc") for _ in range(draw.randrange(60))), f"h{i % 3}") for i in range(300)]
    docs = odd_docs(spark).unionByName(odd_docs(spark, rows))
    out = quality_rules.judge(docs)
    for r in out.join(docs.select("doc_id", "source", "text"), ["doc_id", "source"]).collect():
        n, chars, symbols, dup, rep = plain_figures(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, rep), r.text
        assert r.base_failed == (n < 20 or 100 * rep > 30 * n)
    assert out.count() == docs.count()
    assert quality_rules.judge(docs.limit(0)).count() == 0


def test_host_verdict(spark):
    good, bad = " ".join(f"w{i}" for i in range(30)), "short"
    rows = [(i, good if i % 10 else bad, "fine") for i in range(200)] + [(1000 + i, bad if i % 10 else good, "spam") for i in range(200)] + [(5000, good, "new"), (5001, good, None)]
    docs = odd_docs(spark, rows)
    out = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert out[1].kept and not out[0].kept and not out[1000].kept and out[1000].host_rejected and not out[1000].base_failed and out[5000].kept and out[5001].kept
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {k for k, r in out.items() if r.kept}
    assert quality_rules.filter_documents(docs.limit(0)).count() == 0


def test_rules_filter_reads_texts_once(spark):
    """The filter writes what it keeps: same rows as the verdicts, odd columns and all."""
    rows = [(i, " ".join(f"w{k}" for k in range(i % 37)), f"h{i % 5}" if i % 7 else None) for i in range(400)]
    docs = odd_docs(spark, rows).withColumn("row", F.lit("r")).withColumn("failed", F.lit("f")).withColumn("bad", F.lit("b")).withColumn("c0", F.array(F.lit(1)))
    kept = quality_rules.filter_documents(docs)
    assert kept.columns == docs.columns and kept.dtypes == docs.dtypes
    expected = {r.doc_id for r in quality_rules.judge(docs).filter("kept").collect()}
    assert sorted(r.doc_id for r in kept.collect()) == sorted(expected) and kept.filter("failed <> 'f' OR c0[0] <> 1").count() == 0


def test_rules_write_few_files(spark, tmp_path, monkeypatch):
    """Figures go to few files whatever the number of splits, all rows of them; a large table gets more, up to a shuffle's."""
    draw = random.Random(5)
    rows = [(i, " ".join(draw.choice("abc") for _ in range(i % 60)), f"h{i % 3}") for i in range(400)]
    odd_docs(spark, rows).repartition(20).write.parquet(str(tmp_path / "docs"))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    spark.conf.set("spark.sql.files.openCostInBytes", "8k")
    try:
        docs = spark.read.parquet(str(tmp_path / "docs"))
        out = quality_rules.judge(docs)
        assert len(docs.inputFiles()) == 20 and docs.rdd.getNumPartitions() >= 10 and len(out.inputFiles()) == 1
        texts = {i: text for i, text, _ in rows}
        got = [(r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in out.collect()]
        assert sorted(got) == sorted((i, *plain_figures(text)) for i, text in texts.items())
        parts = lambda: quality_rules.gathered(docs, docs).rdd.getNumPartitions()
        monkeypatch.setattr(quality_rules, "SMALL_BYTES", 1)
        assert parts() == spark.sparkContext.defaultParallelism
        monkeypatch.setattr(quality_rules, "LARGE_BYTES", 1)
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        assert parts() == 11
        crossed = docs.crossJoin(spark.createDataFrame([(1,)], "n long"))  # nothing is known of its size
        assert quality_rules.gathered(crossed, crossed) is crossed
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_very_long_texts(spark):
    """Texts of some megabytes, read whole."""
    words = " ".join(f"w{i % 5000}x" for i in range(300_000))
    docs = spark.createDataFrame([(1, words, "s"), (2, words + " end", "s"), (3, None, "s"), (4, "y" * 2_000_000, "s")], "doc_id long, text string, source string")
    ids = {r.doc_id: r for r in bpe.digests(bpe.transcode(docs, queries.byte_bpe())).collect()}
    assert ids[1].decoded_sha256 == hashlib.sha256(words.encode()).hexdigest() and ids[2].n_tokens == ids[1].n_tokens + 1 and ids[3].n_tokens == 0
    assert ids[4].decoded_sha256 == hashlib.sha256(b"y" * 2_000_000).hexdigest()
    figures = {r.doc_id: r for r in quality_rules.judge(docs).collect()}
    assert (figures[1].n_words, figures[1].n_repeat_words, figures[2].n_words) == (300_000, 300_000, 300_001)
    assert {r.doc_id: r["size"] for r in mixing.mix(docs).collect()} == {1: 300_000, 2: 300_001, 3: 0, 4: 1}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.join(docs).collect()}
    assert got[1][0] == 5000 and got[2] == (5001, 1) and got[4] == (1, 4)


# 4 Licences


def test_licenses(spark):
    mit = licenses.KNOWN[0][1]
    variant = "Copyright (c) 2020 Some One\nAll rights reserved.\n\n" + mit.upper().replace("SUBLICENSE", "sub-licence").replace("COPYRIGHT HOLDERS", "Copyright Owners").replace(",", " ;")
    rows = [(1, mit, "s"), (2, variant, "s"), (3, mit + " extra", "s"), (4, "prose here.\nReleased under the MIT Licence!", "s"), (5, None, "s"), (6, "", "s"), (7, "Copyright 2020 X", "s"), (1, mit, "s"),
            (8, "Licensed under the Apache License, Version 2.0.\nreleased under the MIT license", "s"), (9, "© 2021 Y\r\n" + licenses.KNOWN[5][1].replace("\n", "\r\n"), "s")]
    out = licenses.scan(odd_docs(spark, rows))
    assert out.columns == ["doc_id", "digest", "license_id", "notices"] and out.count() == len(rows)
    got = {r.doc_id: (r.license_id, r.notices) for r in out.collect()}
    assert got[1][0] == got[2][0] == "MIT" and got[3][0] is None and got[4] == (None, "MIT") and got[5] == got[6] == got[7] == (None, "") and got[8] == (None, "Apache-2.0,MIT") and got[9][0] == "BSD-3-Clause"
    assert licenses.scan(odd_docs(spark).limit(0)).count() == 0


def test_license_items_and_blocks(spark, monkeypatch):
    """Clause (c) of a list counts; a whole licence behind other text is found as a block, by maps and by a join."""
    terms = "You may: \n(a) copy it\n(b) sell it\n{}\nand no more."
    known = [("own", terms.format("(c) keep this notice in all copies")), ("own", "the house rules apply"), ("zz", "the house rules apply")]
    mit = licenses.KNOWN[0][1]
    rows = [
        (1, known[0][1]), (2, terms.format("(c) do as you like")), (3, terms.format("(c) 2020 Some One\n(c) keep this notice in all copies")), (4, "a readme\n\n\n" + known[0][1].replace("\n", "\r\n") + "\n-----\nmore"),
        (5, "x\n====\n" + known[0][1]), (6, "x\n" + known[0][1]), (7, "x\nThe House Rules apply!"), (8, None), (9, ""), (9, " - "), (10, "word " * 200_000 + "\n\n\nthe house rules apply"),
    ]
    expected = [(1, "own", "own"), (2, None, ""), (3, "own", "own"), (4, None, "own"), (5, None, "own"), (6, None, ""), (7, None, "own"), (8, None, ""), (9, None, ""), (9, None, ""), (10, None, "own")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("row", F.lit(1)).withColumn("units", F.lit(1)).withColumn("digest", F.lit(1))
    for most in (20_000, 1):
        monkeypatch.setattr(licenses, "MOST_KNOWN", most)
        got = sorted(((r.doc_id, r.license_id, r.notices) for r in licenses.scan(docs, known=known).collect()), key=str)
        assert got == sorted(expected, key=str)
        assert {r.notices for r in licenses.scan(docs, known=spark.createDataFrame([], "license_id string, text string")).collect()} == {""}
    monkeypatch.undo()
    got = licenses.scan(spark.createDataFrame([(1, "# Tool\n\nIt works.\n\n\n" + mit.replace("\n\n", "\n \n")), (2, licenses._UNLICENSE.upper()), (3, licenses.KNOWN[0][1].replace("\n\n", "\n\n\n\n"))], "doc_id long, text string"))
    assert {r.doc_id: (r.license_id, r.notices) for r in got.collect()} == {1: (None, "MIT"), 2: ("Unlicense", "Unlicense"), 3: ("MIT", "")}


def test_license_notices_of_the_documents(spark):
    import pandas as pd

    folder = "/root/testdata/sf0.01"
    lines = {
        "Licensed under CC BY-NC 4.0.": "CC-BY-NC-4.0", "Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
    }
    docs = pd.read_parquet(f"{folder}/documents.parquet")
    expected = {i: ",".join(sorted({lines[x.strip()] for x in (t or "").split("\n") if x.strip() in lines})) for i, t in zip(docs.doc_id, docs.text, strict=True)}
    assert {r.doc_id: r.notices for r in queries.QUERIES["op4_license_scan"](spark, folder).collect()} == expected
    assert sum("CC-BY-NC-4.0" in x for x in expected.values()) == 4


def test_license_short_forms_and_whole_texts(spark):
    # ids are given here, not taken from the table
    short = {
        "Released under CC BY-NC 4.0": "CC-BY-NC-4.0", "licensed under a CC-BY-NC-SA 4.0 licence": "CC-BY-NC-SA-4.0", "Licensed under CC BY-ND 3.0.": "CC-BY-ND-3.0", "Licensed under CC BY 4.0": "CC-BY-4.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.": "CC-BY-NC-ND-4.0", "Released under CC0 1.0.": "CC0-1.0",
        "Released under the GNU Lesser General Public License, version 2.1.": "LGPL-2.1", "Licensed under the GNU Affero General Public License v3.": "AGPL-3.0", "Licensed under the Mozilla Public License 2.0": "MPL-2.0", "Licensed under CC BY-NC 9.0.": "",
    }
    got = licenses.scan(spark.createDataFrame([(i, "prose\n" + x) for i, x in enumerate(short)], "doc_id long, text string")).collect()
    assert {r.doc_id: r.notices for r in got} == dict(enumerate(short.values()))
    folder = "/usr/share/common-licenses"
    whole = {"Apache-2.0": "Apache-2.0", "GPL-2": "GPL-2.0", "GPL-3": "GPL-3.0", "LGPL-2.1": "LGPL-2.1", "LGPL-3": "LGPL-3.0", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    whole = {k: v for k, v in whole.items() if os.path.exists(f"{folder}/{k}")}
    texts = {k: open(f"{folder}/{k}", encoding="utf-8").read() for k in whole}
    rows = [(k, t) for k, t in texts.items()] + [(k, t.split("END OF TERMS AND CONDITIONS")[0].replace("https://", "http://")) for k, t in texts.items()]
    assert [r.license_id for r in licenses.scan(spark.createDataFrame(rows, "doc_id string, text string").coalesce(1)).collect()] == [*whole.values()] * 2


# 5 HTML


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (None, ""), ("", ""), ("<p>Hello world.</p>", "Hello world."), ("plain < text &amp; more", "plain < text & more"), ("<b", ""), ("<!-- x --><?xml?><!DOCTYPE html>", ""),
        ("<nav><a href=x>Home</a></nav><p>One short.</p><p>The cat sat on the mat and it was a good day for all of the people there.</p><footer>c</footer>", "One short.\nThe cat sat on the mat and it was a good day for all of the people there."),
        ('<article><h1>T</h1><p>a</p><div class="comments"><p>a reader said this and that to the author</div><p class="ad">Buy<p>b &lt;x&gt; &amp;amp;&nbsp;c</article><div>cookie</div>', "T\na\nb <x> &amp; c"),
        ('<article><p>x<script>if(a<b){"</p>"}</script>y<br>z<br><br>q<style>p{}</style><ul><li>one<li>two</ul></article>', "xy z\nq\none\ntwo"),
        ("<header>Site</header><main><header><h1>Title</h1><span>by someone</span></header><p>Body</p><form>f<input></form><aside>more</aside></main>", "Title\nBody"),
        ("<article><p>k <i>e</i>e</p><table><tr><td>1</td><td>2</td></tr></table><pre>a\n  b</pre></article>", "k ee\n1 2\na b"),
        ('<div id="sidebar">s</div><div role="banner">r</div><div hidden>h</div><div class="cookie-notice">n</div><div class="adBox">x</div><article>only</article>', "only"),
        ("<article><p>" + "word " * 3000 + "</p></article>", ("word " * 3000).strip()),
        ("<ul><li><a href=1>A</a><li><a href=2>B</a></ul><p>" + "The story of the day is that we are here and it is good. " * 5 + "</p>", ("The story of the day is that we are here and it is good. " * 5).strip()),
    ],
)
def test_html(page, text):
    assert html_extract.main_text(page) == text


PROSE = "The story of the day is that we are here and it is good for all of us to be in this place at this time of the year. " * 2


@pytest.mark.parametrize("name", ["article-header", "search-result-main", "rail-transport", "social-history", "post comments-closed", "entry-footer post", "sidebar", "header"])
def test_html_names_around_the_text(name):
    """Names with other words tell nothing; exact ones neither, where all the prose is in them."""
    text = PROSE.strip()
    assert html_extract.main_text(f'<div class="{name}"><h2>Head</h2><p>{text}</p><p>{text}</p><p>{text}</p></div>') == f"Head\n{text}\n{text}\n{text}"


def test_html_without_marks():
    text = PROSE.strip()
    menu = "<div><a href=1>Home</a> <a href=2>News of today and more</a></div>"
    page = f"<body>{menu}<div>Log in</div><div><h1>Head</h1><p>Short one.</p><p>{text}</p><p>{text}</p><h3>More</h3><p>ok</p><p>{text}</p></div><div><ul><li><a href=3>Next</a></ul></div><div>Contact</div></body>"
    assert html_extract.main_text(page) == f"Head\nShort one.\n{text}\n{text}\nMore\nok\n{text}"
    # exact names beside prose: notices, adverts and readers' comments go, however long
    page = f'<div class="ad">{text}</div><div><p>{text}</p></div><div id="comments"><h3>Comments</h3><p>{text}</p><p>{text}</p></div><div class="cookie-notice box">{text}</div>'
    assert html_extract.main_text(page) == text
    # a language without stop words here, and a page in a form
    other = "xyloph qwert zuiop asdfg hjkl yxcv bnm " * 8
    assert html_extract.main_text(f"<div><p>{other}</p></div>{menu}") == other.strip()
    assert html_extract.main_text(f"<form><div>{menu}<p>{text}</p><p>{text}</p><p>{text}</p></div></form>") == f"{text}\n{text}\n{text}"
    assert html_extract.main_text(f"<article><h1>A</h1><p>b</p></article><article><p>{text}</p></article>{menu}") == f"A\nb\n{text}"


def test_html_density_decides():
    """The same words in the same places: prose stays, a list of names doesn't."""
    text, names = PROSE.strip(), ("Xylo Qwert Zuiop Asdfg Hjkl Yxcv " * 7).strip()
    page = "<div><p>{}</p></div><div><p>{}</p></div><div><div><p>{}</p></div></div>"
    assert html_extract.main_text(page.format(text, text, names)) == f"{text}\n{text}"
    assert html_extract.main_text(page.format(text, text, text)) == f"{text}\n{text}\n{text}"


def test_html_deep_and_long():
    import time

    begun = time.monotonic()
    text = PROSE.strip()
    assert html_extract.main_text("<div>" * 100_000 + f"<p>{text}</p>" + "</span></b>" * 100_000) == text
    assert html_extract.main_text("<div><span>" * 100_000 + text + "</div>" * 100_000) == text
    assert html_extract.main_text(f"<p>{text}</p>" * 50_000).count("\n") == 49_999
    assert time.monotonic() - begun < 30


def test_html_survives_anything():
    draw = random.Random(4)
    parts = ["<", ">", "</p>", "<p>", "<div class='", "'", '"', "&", "&amp", "<!--", "-->", "<script>", "</script", "text", "<br/>", "</article>", "<article>", "<a href=x>", "\x00", "é", "<svg/>", "<li"]
    for _ in range(2000):
        html_extract.main_text("".join(draw.choice(parts) for _ in range(draw.randrange(40))))


def test_html_query(spark, data):
    """Against the pages' articles, cut out plainly; nearly all the same without their marks."""
    import html

    import pandas as pd

    found = {r.page_id: r for r in queries.op5_html_extraction(spark, data).collect()}
    same, pages = 0, list(pd.read_parquet(f"{data}/pages.parquet").itertuples())
    for p in pages:
        article = re.search(r"<article>(.*)</article>", p.html, re.DOTALL)[1]
        cut = [" ".join(html.unescape(re.sub("<[^>]+>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:p|h1)>", article)]
        assert found[p.page_id].text == "\n".join(filter(None, cut)) and found[p.page_id].n_chars == len(found[p.page_id].text)
        same += html_extract.main_text(p.html.replace("<article>", "<div>").replace("</article>", "</div>")) == found[p.page_id].text
    assert same >= 0.9 * len(pages)
    pages = spark.createDataFrame([(1, None, None), (1, None, None)], "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("page", F.lit(2)).withColumn("k0", F.lit(3)).withColumn("k1", F.lit(4))
    assert [tuple(r) for r in html_extract.extract(pages).collect()] == [(1, None, "")] * 2
    assert html_extract.extract(pages.limit(0)).count() == 0


# 6 N-gram join


def plain_components(rows, width=5, percent=75):
    sets = []
    for _, text in rows:
        w = WORD.findall((text or "").translate(LOW))
        sets.append({tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set())
    inverted = defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            inverted[x].append(i)
    shared = Counter(p for docs in inverted.values() for p in itertools.combinations(docs, 2))
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for (a, b), c in shared.items():
        if 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            x, y = top(a), top(b)
            up[max(x, y)] = min(x, y)
    names = defaultdict(list)
    for i, (ref, _) in enumerate(rows):
        names[top(i)].append(ref)
    least = {k: min((r for r in v if r is not None), default=None) for k, v in names.items()}
    return Counter((ref, len(sets[i]), least[top(i)]) for i, (ref, _) in enumerate(rows))


def joined(df, **options):
    return Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(df, **options).collect())


@pytest.fixture
def near(data):
    """Documents, and copies of some with words changed, cut and moved."""
    draw = random.Random(6)
    rows = [(int(i), t) for i, t in texts(data).head(60)[["doc_id", "text"]].itertuples(index=False)]
    base = [f"w{draw.randrange(500)}" for _ in range(60)]
    passage = [f"p{k}" for k in range(40)]
    for i in range(90):
        words = list(base)
        for _ in range(draw.randrange(4)):
            words[draw.randrange(60)] = f"c{draw.randrange(9)}"
        rows.append((1000 + i, " ".join(words)))
    for i in range(90):  # many texts share a passage and little else
        rows.append((2000 + i, " ".join([*(f"u{i}x{k}" for k in range(draw.randrange(5, 60))), *passage])))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("small", "texts_a_block", "groups"), [(64, 256, 12), (3, 7, 2), (1, 1, 1)])
def test_join_equals_plain(spark, near, monkeypatch, small, texts_a_block, groups):
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "BLOCK_TEXTS", texts_a_block)
    monkeypatch.setattr(ngram_join, "OWN_BLOCKS", 8)
    monkeypatch.setattr(ngram_join, "GROUP_BLOCKS", groups)
    df = spark.createDataFrame(near, "doc_id long, text string")
    assert joined(df) == plain_components(near)


def test_join_by_shuffles_and_buckets(spark, near, monkeypatch):
    """The ways that large inputs take."""
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
    monkeypatch.setattr(ngram_join, "GATHERED", 50)
    monkeypatch.setattr(ngram_join, "LEAST_BUCKETS", 3)
    monkeypatch.setattr(ngram_join, "MARGIN", 1000)
    monkeypatch.setattr(ngram_join, "MOST_COUNTERS", 4)
    monkeypatch.setattr(ngram_join, "LEAST_COUNTERS", 4)
    df = spark.createDataFrame(near, "doc_id long, text string")
    assert joined(df) == plain_components(near)


def test_join_odd(spark):
    docs = odd_docs(spark)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert joined(docs) == plain_components(rows)
    assert joined(docs.limit(0)) == Counter()
    some = spark.createDataFrame([("b", "a b c d e f"), ("a", "A B c d e f"), ("c", "x")], "doc_id string, text string")
    assert joined(some) == Counter([("b", 2, "a"), ("a", 2, "a"), ("c", 1, "c")])
    assert joined(some, measure=ngram_join.Measure(2, 10)) == Counter([("b", 5, "a"), ("a", 5, "a"), ("c", 1, "c")])
    one = ngram_join.one_of_each(docs)
    assert one.columns == docs.columns and Counter(r.doc_id for r in one.collect())[5] == 1
    assert ngram_join.one_of_each(docs.limit(0)).count() == 0
    assert sorted(r.doc_id for r in ngram_join.one_of_each(spark.createDataFrame([(3, "q r"), (1, "q r"), (2, None)], "doc_id int, text string")).collect()) == [1, 2]


# 7 Mixing


def plain_targets(sizes, weights=mixing.WEIGHTS):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = 1.5 * total - sum(2 * sizes[s] for s in capped)
        open_weight = sum(w[s] for s in order if s not in capped)
        level = rest / open_weight if open_weight else 0
        more = {s for s in order if s not in capped and level * w[s] > 2 * sizes[s]}
        if not more:
            return {s: min(2 * sizes[s], level * w[s]) if s not in capped else 2 * sizes[s] for s in order}
        capped |= more


@pytest.mark.parametrize("rows_a_bin", [1, 7, 2000])
def test_mixing(spark, monkeypatch, rows_a_bin):
    monkeypatch.setattr(mixing, "ROWS_PER_BIN", rows_a_bin)
    draw = random.Random(7)
    rows = [(i, " ".join(["w"] * draw.choice([0, 1, 5, 300])), draw.choice(["a", "b", "b", "b", "é", "Z", None])) for i in range(400)] + [(1000, None, "none"), (1001, "w " * 5000, "long"), (3, "w w", "b"), (3, "w w", "b")]
    docs = odd_docs(spark, rows)
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(3)).collect()
    key = lambda r: tuple(map(str, r))
    assert sorted(got, key=key) == sorted(again, key=key) and len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    taken, target = defaultdict(int), plain_targets(sizes)
    for r in got:
        assert r.source_size == sizes[r.source] and r.taken <= 2 * r.size and r.target == pytest.approx(target[r.source], rel=1e-12)
        taken[r.source] += r.taken
    for s in sizes:
        assert abs(taken[s] - target[s]) <= 3, s
    copies = mixing.mix_rows(docs)
    assert copies.columns == docs.columns
    words = defaultdict(int)
    for r in copies.collect():
        words[r.source] += len((r.text or "").split())
    for s in sizes:
        assert abs(words[s] - target[s]) <= (5000 if s == "long" else 300) + 4


def test_mixing_many_sources(spark):
    """Targets by one sort equal those by rounds, with many sources at their cap, ties and empty ones."""
    draw = random.Random(17)
    sizes = {f"s{i:03d}": draw.choice([0, 1, 7, 7, 50, 400, 9000]) for i in range(300)} | {"huge": 2_000_000}
    found = spark.createDataFrame([(1, s, n) for s, n in sizes.items()], "doc_id long, source string, size long").repartition(5)
    got = {r.source: r.target for r in mixing.targets(found, Scratch(spark, "test")).collect()}
    assert got == pytest.approx(plain_targets(sizes), rel=1e-12)
    everything = mixing.targets(found, Scratch(spark, "test"), share=2.0).collect()
    assert all(r.target == pytest.approx(2 * r.source_size) for r in everything)


def test_mixing_empty(spark):
    assert mixing.mix(odd_docs(spark).limit(0)).count() == 0 and mixing.mix_rows(odd_docs(spark).limit(0)).count() == 0
    nothing = odd_docs(spark, [(1, None, "a"), (2, " ", None)])
    assert [(r.size, r.target, r.taken) for r in mixing.mix(nothing).collect()] == [(0, 0.0, 0)] * 2


# 8 Top-k


def plain_top(rows, k=20):
    good = [(i, [math.floor(64 * Fraction(x)) for x in v]) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = set()
    for q, qv in good:
        if q % 20 == 0:
            scores = sorted((-max(min(sum(a * b for a, b in zip(qv, v, strict=True)), 2**63 - 1), -(2**63)), i) for i, v in good if i != q and len(v) == len(qv))
            out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])}
    return out


@pytest.mark.parametrize(("block", "asked", "held", "scale"), [(8192, 512, 48, 1.0), (30, 3, 2, 1.0), (7, 3, 1, 40.0), (30, 3, 3, 1e9), (30, 3, 3, 1e20), (30, 3, 2, 1e307)])
def test_top_k(spark, monkeypatch, block, asked, held, scale):
    for name, value in (("BLOCK_ROWS", block), ("BLOCK_QUERIES", asked), ("GROUP_BLOCKS", held), ("TASK_PAIRS", 1 if held < 48 else 16_000_000)):
        monkeypatch.setattr(vafile, name, value)
    draw = np.random.default_rng(8)
    rows = [(i, (draw.normal(size=6) * scale).tolist()) for i in range(200)]
    rows += [(300 + i, rows[40][1]) for i in range(60)]  # ties
    rows += [(440, [0.0] * 6), (460, [scale, 0, 0, 0, 0, 0]), (480, [0, 0, 0, 0, 0, -scale])]  # ties of different vectors
    rows += [(400, None), (401, []), (402, [1.0, None]), (403, [float("nan")] * 6), (404, [float("inf")] * 6), (420, [1.0, 2.0]), (421, [3.0, 4.0]), (500, [1.0]), (None, rows[0][1])]
    df = spark.createDataFrame([(i, v and [None if x is None else float(x) for x in v]) for i, v in rows], "vec_id long, embedding array<double>")
    df = df.withColumn("block", F.lit("x")).withColumn("width", F.lit("x")).withColumn("q", F.lit("x")).repartition(3)
    got = vafile.top_k(df, F.col("vec_id") % 20 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    found = [tuple(r) for r in got.collect()]
    assert set(found) == plain_top(rows) and len(found) == len(set(found))
    assert vafile.top_k(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_top_k_repeated_ids(spark):
    """A query is an id, however often its row is there; every candidate row counts."""
    vectors = "vec_id long, embedding array<double>"
    ranked = lambda rows, k: [(r["rank"], r.vec_id, r.score) for r in vafile.top_k(spark.createDataFrame(rows, vectors), F.col("vec_id") == 0, k=k).orderBy("rank").collect()]
    one = [(1, [1.0, 0.0]), (2, [0.5, 0.0]), (3, [0.25, 0.0])]
    assert ranked([(0, [1.0, 0.0])] * 3 + one, 2) == [(1, 1, 4096), (2, 2, 2048)]
    assert ranked([(0, [1.0, 0.0])] * 30 + one + one[:1] * 2, 4) == [(1, 1, 4096), (2, 1, 4096), (3, 1, 4096), (4, 2, 2048)]
    # the query's own id first among many copies of its vector
    copies = [(0, [1.0, 0.0])] * 9 + [(i, [1.0, 0.0]) for i in range(5, 40)]
    assert ranked(copies, 3) == [(1, 5, 4096), (2, 6, 4096), (3, 7, 4096)]


@pytest.mark.parametrize("block", [8192, 12])
def test_top_k_one_id_with_many_vectors(spark, monkeypatch, block):
    import duckdb

    monkeypatch.setattr(vafile, "BLOCK_ROWS", block)
    rows = [(0, [50.0 + i, 0.0]) for i in range(25)] + [(20, [40.0 + i, 1.0]) for i in range(3)] + [(1 + i, [1.0 + i / 8, 0.5]) for i in range(15)]
    rows += [(60, [9.0, 9.0]), (60, [9.0, 9.0]), (7, [50.0, 0.0]), (8, [0.0, -3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    embeddings = df.toPandas()  # noqa: F841, the SQL's table
    expected = sorted(duckdb.sql(queries.ORACLES["op8_top_k"]).fetchall())
    assert len(expected) == 60
    assert sorted(tuple(r) for r in vafile.top_k(df, F.col("vec_id") % 20 == 0, k=20).collect()) == expected


def test_top_k_reads_few_vectors(spark):
    """At most a tenth of the exact vectors, with coarse cells too."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    n, asked = df.count(), df.filter("vec_id % 20 = 0").count()
    for scale in (64.0, 10_000.0):
        rows = vafile._stored(df, "vec_id", "embedding", F.col("vec_id") % 20 == 0, scale).cache()
        key = ["width", "kind", "packed"]
        exact = rows.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("id", F.lit(1).alias("n")))).alias("ids")).withColumn("vec", F.monotonically_increasing_id()).cache()
        numbered = rows.filter("q").select(*key, "id").withColumn("number", F.monotonically_increasing_id()).cache()
        file, blocks = vafile._file(exact).cache(), vafile._query_blocks(numbered).cache()
        assert file.select(F.sum(F.octet_length("cells"))).first()[0] == 64 * exact.count()  # a byte a component
        parts, _ = vafile.survivors(file, blocks, 20)
        left = parts.count()
        assert 20 * asked <= left <= 0.1 * n * asked, (left, n * asked)


# 9 and 10 Classifiers


def plain_forward(p, rows, size):
    """The logit of one window, number by number."""
    sig = lambda x: 1 / (1 + math.exp(-x))
    states = []
    for side in "fb":
        h, found = [0.0] * size, []
        for x in rows if side == "f" else rows[::-1]:
            gate = lambda k, x=x, h=h: (sum(x[i] * p[f"w{side}"][i, k] for i in range(len(x))) + p[f"c{side}"][k], sum(h[i] * p[f"u{side}"][i, k] for i in range(size)))
            z, r = [sig(sum(gate(k))) for k in range(size)], [sig(sum(gate(size + k))) for k in range(size)]
            new = [math.tanh(gate(2 * size + k)[0] + r[k] * gate(2 * size + k)[1]) for k in range(size)]
            h = [(1 - z[k]) * new[k] + z[k] * h[k] for k in range(size)]
            found.append(h)
        states.append(found if side == "f" else found[::-1])
    states = [a + b for a, b in zip(*states, strict=True)]
    a = [sum(math.tanh(sum(s[i] * p["wa"][i, j] for i in range(2 * size)) + p["ca"][j]) * p["va"][j] for j in range(len(p["va"]))) for s in states]
    weight = [math.exp(x - max(a)) for x in a] if a else []
    context = [sum(w * s[i] for w, s in zip(weight, states, strict=True)) / sum(weight) if a else 0.0 for i in range(2 * size)]
    return sum(c * w for c, w in zip(context, p["wo"], strict=True)) + p["co"][0]


def plain_windows(words):
    return [words[k : k + 32] for k in range(0, max(1, -(-(len(words) - 32) // 16) * 16 + 1 if len(words) > 32 else 1), 16)]


def drawn_scorer():
    draw = np.random.default_rng(6)
    tables = toxicity.Tables.drawn(1)
    tables.word += draw.normal(size=tables.word.shape).astype(np.float32)
    tables.grams[:-1] += draw.normal(size=tables.grams[:-1].shape).astype(np.float32)
    return toxicity.Scorer(tables, toxicity.Network(3), np.array([0.9, 0.4, 0.2, -0.3]))


def test_toxicity_score_is_the_plain_one():
    """Embeddings, windows, network and summary against loops over letters, words and numbers."""
    import pyarrow as pa

    draw, scorer = random.Random(5), drawn_scorer()
    letters = ["a", "b", "É", "ß", "trash", "clown", "Ing"]
    rows = ["", None, "one", "Ab ab AB"] + [" ".join("".join(draw.choices(letters, k=draw.randrange(1, 4))) for _ in range(n)) for n in (5, 32, 33, 48, 49, 100)]
    got = scorer.score(pa.array(rows))

    def inputs(word):
        raw = word.encode()
        buf = np.frombuffer(raw + b"\0" * 8, np.uint8).copy()
        h = int(tk.hash_spans(buf, np.array([0]), np.array([len(raw)]))[0])
        total = np.zeros(toxicity.GRAM_SIZE)
        for n, tail in [(n, False) for n in toxicity.STARTS] + [(n, True) for n in toxicity.ENDS]:
            if len(raw) >= n:
                lane = int.from_bytes(raw[-n:] if tail else raw[:n], "little") ^ ((n + 100 * tail) << 56 | n * 0x1F3)
                total += scorer.tables.grams[int(tk.mix(np.array([lane], np.uint64))[0]) >> 64 - toxicity.GRAM_BITS]
        return [*scorer.tables.word[h >> 64 - toxicity.WORD_BITS].tolist(), *total.tolist(), math.log1p(len(raw)) - 1.5]

    for text, score in zip(rows, got, strict=True):
        words = re.findall(r"[^\W\d_]+", (text or "").replace("É", "é").lower())
        logits = sorted((plain_forward(scorer.network.p, [inputs(w) for w in window], toxicity.HIDDEN) for window in plain_windows(words)), reverse=True)
        x = 0.9 * logits[0] + 0.4 * sum(logits[:3]) / len(logits[:3]) + 0.2 * math.log(len(logits)) - 0.3
        assert score == pytest.approx(1 / (1 + math.exp(-x)), abs=1e-4)


def test_toxicity_reads_long_texts_in_segments(monkeypatch):
    import pyarrow as pa

    draw, scorer = random.Random(7), drawn_scorer()
    word = lambda: "".join(draw.choices("abcdeé", k=draw.randrange(1, 12)))
    rows = [" ".join(word() for _ in range(n)) for n in (0, 3, 31, 32, 33, 48, 49, 64, 500, 501, 2000)] + ["7" * 3000 + " one two " + "-" * 5000 + " ".join(word() for _ in range(40)), "x" * 4000, ("y" * 900 + " ") * 20, None]
    whole = scorer.summaries(pa.array(rows))
    for size in (40, 333, 1000):
        monkeypatch.setattr(toxicity, "SEGMENT", size)
        assert np.allclose(scorer.summaries(pa.array(rows)), whole, atol=1e-4), size
        assert np.allclose(scorer.summaries(pa.array(["skip", *rows])[1:]), whole, atol=1e-4)
    # the words of a sample, read in segments too
    monkeypatch.undo()
    once = toxicity._sampled(pa.array([r or "" for r in rows], pa.large_string()))
    monkeypatch.setattr(toxicity, "SEGMENT", 100)
    parts = toxicity._sampled(pa.array([r or "" for r in rows], pa.large_string()))
    for name in ("of", "first", "hash", "grams", "length"):
        assert (getattr(once, name) == getattr(parts, name)).all(), name
    assert [once.first[i + 1] - once.first[i] for i in range(5)] == [0, 3, 31, 32, 33]


def test_network_gradient():
    """By parameters and by inputs, against differences."""
    draw = np.random.default_rng(0)
    x, windows, y = draw.normal(size=(50, toxicity.INPUTS)), draw.integers(0, 51, (7, toxicity.WINDOW)), draw.integers(0, 2, 7)
    windows[3] = 50  # an empty window
    net = toxicity.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    g, by_input = net.gradient(x, windows, y, np.ones(7))
    loss = lambda: np.mean(np.logaddexp(0, -np.where(y > 0, 1, -1) * net.forward(x, windows)))
    for k, p in [*net.p.items(), *[("inputs", x)] * 5]:
        at = draw.integers(p.size)
        was = p.ravel()[at]
        p.ravel()[at] = was + 1e-3
        up = loss()
        p.ravel()[at] = was - 1e-3
        slope = (up - loss()) / 2e-3
        p.ravel()[at] = was
        assert slope == pytest.approx((by_input if k == "inputs" else g[k]).ravel()[at], abs=2e-5), k


def test_evidence_finds_words_and_parts():
    import pyarrow as pa

    draw = random.Random(9)
    word = lambda: "".join(draw.choices("abcdefgh", k=7))
    rows = [" ".join([*(word() for _ in range(60)), *(["scum" if i % 2 else "zzq" + word()] if i % 4 < 2 else [])]) for i in range(200)]
    ((_, _, buf, offsets),) = tk.pieces(pa.array([*rows, "scum", "zzqabc", "bcdefgh"]), 2**40)
    words, _, _ = toxicity._words(toxicity._lowered(buf), offsets)
    known = toxicity._evidence(words, np.arange(200), np.array([int(i % 4 < 2) for i in range(200)]))
    a = known[0][words.word] + known[1][words.grams].sum(1)
    scum, part, other = (a[words.of[words.first[200 + k]]] for k in range(3))
    assert scum > 2 and part > 2 and other < 1


def test_windows_cover_texts():
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        of = np.arange(n, dtype=np.int32)
        start, end, begin = toxicity._windows(np.array([0, n]))
        windows = toxicity._filled(of, start, end, n)
        assert [[x for x in w if x < n] for w in windows.tolist()] == plain_windows(list(range(n))) and begin.tolist() == [0, len(start)]
        assert set(windows[windows < n].tolist()) == set(range(n))


def rank_quality(scores, labels):
    ones, zeros = ([s for s, y in zip(scores, labels, strict=True) if y == c] for c in (1, 0))
    return np.mean([(a > b) + 0.5 * (a == b) for a in ones for b in zeros])


@pytest.mark.parametrize(("name", "label", "folds", "out", "least"), [("op9_quality_classifier", "quality", 3, 1, 0.99), ("op10_toxicity", "toxic", 5, 0, 0.945)])
def test_held_out(spark, name, label, folds, out, least):
    import zlib

    import pandas as pd

    folder = "/root/testdata/sf0.01"
    found = queries.QUERIES[name](spark, folder).toPandas()
    assert sorted(found.columns) == ["doc_id", "held_out", "predicted", "score"] and found.score.between(0, 1).all()
    assert ((found.score >= 0.5) == (found.predicted == 1)).all()
    assert found.held_out.tolist() == [zlib.crc32(str(i).encode()) % folds == out for i in found.doc_id]
    m = found[found.held_out].merge(pd.read_parquet(f"{folder}/labels.parquet"), on="doc_id")
    assert rank_quality(m.score, m[label]) >= least
    assert len(found) == spark.read.parquet(f"{folder}/documents.parquet").count()


def test_context_vectors_and_score(spark):
    """Against plain loops: the table, the pooled rows and the calibrated score."""
    import pyarrow as pa

    draw = random.Random(3)
    vocabulary = [a + b + "tion" for a in "abcdefgh" for b in "xyzuvw"]  # alike in class, length and ending
    rows = [" ".join(draw.choices(vocabulary, k=30)) for _ in range(12)] + ["rareone axtion rareone bytion", "", None, "solo", "axtion rareone2 bytion", "axtion " * 400]
    texts = spark.createDataFrame([(t,) for t in rows], "text string").repartition(3)
    table = quality_model.context_vectors(texts)
    code = {}
    for w in {w for t in rows for w in re.findall("[a-z]+|[0-9]+", t or "")}:
        ((_, _, buf, offsets),) = tk.pieces(pa.array([w]))
        code[w] = int(quality_model._keys(buf, offsets)[0][0])
    slot = {w: c >> 64 - quality_model.SLOT_BITS for w, c in code.items()}
    assert len(set(code.values())) == len(code) and quality_model.SLOT_BITS >= 18

    def index(w):
        v, bits = np.zeros(32), int(tk.mix(np.array([code[w]], np.uint64) ^ quality_model.INDEX_SEED)[0])
        for k in range(4):
            v[bits >> 6 * k & 31] += -1 if bits >> 6 * k + 5 & 1 else 1
        return v

    plain = defaultdict(lambda: np.zeros(32))
    for t in rows:
        words = re.findall("[a-z]+|[0-9]+", t or "")
        for a, b in zip(words, words[1:]):
            plain[slot[a]] += index(b)
            plain[slot[b]] += index(a)
    unit = lambda v: v / (np.linalg.norm(v) or 1)
    assert table.shape == (1 << quality_model.SLOT_BITS, 32) and set(np.flatnonzero(np.abs(table).sum(1))) == {k for k, v in plain.items() if v.any()}
    for w in code:
        assert np.allclose(table[slot[w]].astype(float), unit(plain[slot[w]]), atol=1e-3)
    assert len({tuple(table[x]) for x in set(slot.values())}) >= len(set(slot.values())) - 1
    got = quality_model.pooled(pa.array(rows), table)
    draw = np.random.default_rng(5)
    net = quality_model.Network(draw.normal(size=65), draw.uniform(1, 2, 65), {"w1": draw.normal(size=(65, 32)), "b1": draw.normal(size=32), "w2": draw.normal(size=32), "b2": draw.normal(size=())}, 1.7)
    scores = net.score(got)
    for t, row, score in zip(rows, got, scores, strict=True):
        vectors = [unit(plain[slot[w]]) for w in re.findall("[a-z]+|[0-9]+", t or "")]
        steps = [abs(x - y) for x, y in zip(vectors, vectors[1:])]
        expected = np.concatenate([np.mean(vectors, axis=0) if vectors else np.zeros(32), sum(steps, np.zeros(32)) / max(len(vectors), 1), [math.log1p(len(vectors))]])
        assert np.allclose(row, expected, atol=1e-3)
        logit = float(net.weights["b2"])
        for h in range(32):
            logit += max(0.0, float(net.weights["b1"][h]) + sum((float(row[k]) - net.mean[k]) / net.scale[k] * net.weights["w1"][k, h] for k in range(65))) * net.weights["w2"][h]
        assert score == pytest.approx(1 / (1 + math.exp(-logit / 1.7)), rel=1e-6)


def test_temperature_is_an_optimum():
    draw = np.random.default_rng(2)
    for scale, noise in ((0.1, 0.1), (1, 1), (30, 0.0), (5, 4)):
        labels = draw.integers(0, 2, 300)
        logits = scale * (2 * labels - 1 + draw.normal(0, noise, 300) if noise else 2 * labels - 1)
        n1 = labels.sum()
        target = np.where(labels > 0, (n1 + 1) / (n1 + 2), 1 / (300 - n1 + 2))
        loss = lambda t: np.mean(np.logaddexp(0, logits / t) - target * logits / t)
        t = fitting.temperature(logits, labels)
        assert loss(t) <= min(loss(t * 1.02), loss(t / 1.02)) and 1e-3 < t < 1e3


def test_labelled_sample(spark):
    """The bound is filled with labels that have a text; long texts count; repeated ids with other texts don't depend on order."""
    docs = spark.createDataFrame([(i, "word " * (i * 20_000)) for i in range(1, 5)] + [(9, "b"), (9, "a"), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(1, 400)] + [(None, 1)], "doc_id long, quality int")
    make = lambda d, bound: fitting.one_per_id(fitting.sample(d, labels, "quality", lambda i: F.lit(True), bound, "doc_id", "text").withColumn("digest", F.md5("text")), "digest", "text", "label")
    got = {r.id: (r.text, r.label) for r in make(docs, 5).collect()}
    assert set(got) == {1, 2, 3, 4, 9} and len(got[4][0]) == 400_000
    assert got[9] == (min("ab", key=lambda x: hashlib.md5(x.encode()).hexdigest()), 1)
    assert {r.id: (r.text, r.label) for r in make(docs.orderBy(F.desc("text")).repartition(3), 5).collect()} == got
    assert make(docs, 2).count() == 2


def test_sums_over_tasks(spark):
    import pyarrow as pa

    draw = np.random.default_rng(1)
    tables = [draw.integers(-5, 6, fitting.CHUNK * 2).astype(np.int32) * (draw.random(fitting.CHUNK * 2) < 0.1) * 10**k for k in (0, 3, 8)]
    packed = [[(c.to_pylist()) for c in b.columns] for t in tables for b in fitting.emit(t.astype(np.int32))]
    rows = [(c[0], bytearray(x[0])) for c, x in packed]
    parts = spark.createDataFrame(rows, "chunk int, numbers binary").repartition(3)
    got = fitting.summed(parts, fitting.CHUNK * 2, lambda x: x, np.int64)
    assert (got == sum(t.astype(np.int64) for t in tables)).all()
    assert pa.types.is_int32(next(fitting.emit(tables[0].astype(np.int32))).column(0).type)


@pytest.mark.parametrize("model", [quality_model, toxicity])
def test_classifier_odd(spark, model):
    docs = odd_docs(spark)
    label = "quality" if model is quality_model else "toxic"
    schema = f"doc_id long, {label} int"
    none = spark.createDataFrame([], schema)
    got = model.score(docs, none).collect()
    assert len(got) == docs.count() and {r.score for r in got} == {0.5 if model is quality_model else 0.0}
    some = spark.createDataFrame([(1, 1), (2, None), (5, 0), (5, 1), (9, 1), (7, 0), (8, 7), (None, 1), (99, 0), (10, 0), (6, 0), (3, 1)], schema)
    got = model.score(docs, some).collect()
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got)
    fives = [r.score for r in got if r.doc_id == 5]
    assert len(fives) == 2 and fives[0] == fives[1]
    assert model.score(docs.limit(0), some).count() == 0
    again = model.score(docs.repartition(2), some).collect()
    assert {r.doc_id: r.score for r in again} == pytest.approx({r.doc_id: r.score for r in got})
    if model is quality_model:
        kept = model.keep_good(docs, some)
        assert kept.columns == docs.columns
