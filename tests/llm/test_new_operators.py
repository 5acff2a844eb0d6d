"""Secret scan, Merkle manifest and tokenizer alignment against plain Python, and on odd rows."""

import hashlib
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SMALL
from tests.llm.conftest import LONG, ODD
from tillframe.llm import alignment, merkle, queries, secret_scan
from tillframe.llm.common import read


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Secrets


BASE = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
}


def plain_secrets(text):
    return sorted((m.start(), rank, m.end(), kind) for rank, (kind, (pattern, check)) in enumerate(BASE.items())
                  for m in pattern.finditer(text or "") if check(m))


def same_secrets(row, text):
    expected = plain_secrets(text)
    assert [row.n_assign, row.n_access, row.n_hex] == [sum(x[3] == kind for x in expected) for kind in BASE]
    spans = [f"{kind}:{a}:{b}" for a, _, b, kind in expected]
    assert row.base_sha256 == sha(",".join(spans))
    assert [x for x in row.spans.split(",") if x and not x.startswith("novel")] == spans
    assert row.n_novel == row.spans.count("novel:")


def test_op11(spark):
    texts = dict(read(spark, SMALL, "documents").select("doc_id", "text").collect())
    rows = queries.op11_secret_novelty(spark, SMALL).collect()
    assert len(rows) == len(texts)
    for row in rows:
        same_secrets(row, texts[row.doc_id])


def test_planted_keys_are_novel_and_little_else(spark):
    rows = queries.op11_secret_novelty(spark, "/root/testdata/sf0.1").filter("spans <> ''").collect()
    ends = [{kind: {x.split(":", 1)[1] for x in row.spans.split(",") if x.startswith(kind)} for kind in ("assign", "hex", "novel")} for row in rows]
    assert sum(row.n_hex for row in rows) > 100
    assert sum(len(x["hex"] & x["novel"]) for x in ends) >= 0.95 * sum(row.n_hex for row in rows)
    for x in ends:  # what else is novel is a key in capitals, which only the wider expression finds
        assert {y.split(":")[1] for y in x["novel"] - x["hex"]} <= {y.split(":")[1] for y in x["assign"]}


def test_secret_expressions_on_odd_texts(documents):
    odd = ['secret: token:abcdefg', 'TOKEN="abc" password = abcdef api_key:\'k.e-y+/=\'', "AKIA" + "A" * 15 + " AKIA" + "B" * 16, "AKIAAKIA" + "C" * 16,
           "f" * 23 + " " + "0" * 24 + "g" + "a" * 50, "ſecret=abcdefg toKen=abcdefg", "日本 token = 日本abcdef token = abcdefgh", None, "", "token" * 3000,
           "token" + " " * 100_000 + "=abcdef", "passwd='" + "z" * 100_000, "a" * 100_000]
    for row in secret_scan.secret_report(documents(*enumerate(odd))).collect():
        same_secrets(row, odd[row.doc_id])


def test_random_strings_in_sensitive_context_are_reported_and_words_are_not(spark, documents):
    draw = random.Random(5)
    prose = list(dict(read(spark, SMALL, "documents").filter("length(text) > 300").select("doc_id", "text").collect()).values())
    kinds = {"base64": string.ascii_letters + string.digits + "+/", "alnum": string.ascii_lowercase + string.digits}
    planted, plain = {}, {}
    for i in range(200):
        text, key = prose[i % len(prose)], "".join(draw.choice(list(kinds.values())[i % 2]) for _ in range(40))
        at = text.find(" ", len(text) // 2) + 1
        planted[i] = (f"{text[:at]}Authorization bearer {key} {text[at:]}", at + 21)
        plain[1000 + i] = f"{text[:at]}Authorization bearer {key} {text[at:]}".replace("Authorization bearer", "and then")
        words = draw.choices(re.findall("[a-z]{3,9}", text) or ["some"], k=4)
        plain[2000 + i] = f"{text[:at]}session {words[0]}{words[1].capitalize()}{words[2].capitalize()}{words[3].capitalize()} {text[at:]}"
    docs = documents(*[(i, text) for i, (text, _) in planted.items()], *plain.items())
    found = {row.doc_id: row.secrets for row in secret_scan.find_secrets(docs).collect()}
    caught = sum(any(x.kind == "novel" and x.start == at and x.value == planted[i][0][at:at + 40] for x in found[i]) for i, (_, at) in planted.items())
    assert caught >= 0.95 * len(planted)
    assert sum(x.kind == "novel" for i in plain for x in found[i] if i < 2000) == 0
    assert sum(x.kind == "novel" for i in plain for x in found[i] if i >= 2000) <= 0.05 * len(planted)


def test_a_repeated_secret_does_not_excuse_itself():
    key = "".join(random.Random(3).choices(string.ascii_letters + string.digits, k=32))
    text = f"session cookie {key} and the same session cookie {key} again"
    found = secret_scan.secrets_of(text, secret_scan.Compressor(b"", secret_scan.Novelty()))
    assert [(a, b) for a, rank, b in found if rank == 3] == [(15, 47), (76, 108)]


def test_identifier_dictionary_counts_documents(documents):
    docs = documents((1, "alpha alpha alpha beta"), (2, "beta gamma_x"), (3, "gamma_x beta"), (4, None), (5, "beta9word"))
    assert secret_scan.identifier_dictionary(docs) == b"gamma_x beta"


# Merkle manifest


def plain_manifest(rows):
    """Per row: leaf, subroot, root, proof_sha256, folded_root, by building every level whole."""
    def field(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    def leaf(row, text):
        return sha("".join(map(field, (row.doc_id, row.source, row.lang, row.n_chars, text))))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i:i + 16])) for i in range(0, len(levels[-1]), 16)])
        return levels

    def path(levels, i):
        steps = []
        for level in levels[:-1]:
            first = i // 16 * 16
            steps.append((i - first, level[first:first + 16]))
            i //= 16
        return steps

    groups = defaultdict(list)
    for row in rows:
        groups[row.source].append((row.doc_id is not None, row.doc_id or 0, leaf(row, row.text), row))
    keys = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {key: tree([x[2] for x in sorted(groups[key], key=lambda x: x[:3])]) for key in keys}
    top = tree([trees[key][-1][0] for key in keys])
    found = []
    for at, key in enumerate(keys):
        for i, (_, _, digest, row) in enumerate(sorted(groups[key], key=lambda x: x[:3])):
            steps = path(trees[key], i) + path(top, at)
            tampered = row.doc_id is not None and zlib.crc32(str(row.doc_id).encode()) % 5 == 0 and row.text is not None
            now = leaf(row, re.sub("[A-Z]", lambda m: m[0].lower(), row.text)) if tampered else digest
            for slot, run in steps:
                now = sha("".join(run[:slot] + [now] + run[slot + 1:]))
            proof = sha("".join(x for slot, run in steps for x in run[:slot] + run[slot + 1:]))
            found.append((row.doc_id, digest, trees[key][-1][0], top[-1][0], proof, now, now == top[-1][0]))
    return Counter(found)


def same_manifest(docs):
    found = merkle.manifest(docs)
    assert set(merkle.RESULTS) <= set(found.columns)
    got = Counter(tuple(row) for row in found.select("doc_id", *merkle.RESULTS).collect())
    expected = plain_manifest(docs.select("doc_id", "source", "lang", "n_chars", "text").collect())
    assert got == expected
    return got


def test_op12(spark):
    got = same_manifest(read(spark, SMALL, "documents"))
    assert {row[-1] for row in got} == {True, False} and len({row[3] for row in got}) == 1


def test_manifest_of_one_tall_tree_and_many_sources(spark):
    docs = spark.range(5000).select(
        (F.pmod(F.xxhash64("id"), F.lit(1 << 40)) - (1 << 39)).alias("doc_id"), F.concat(F.lit("Text "), F.col("id").cast("string")).alias("text"),
        F.lit("en").alias("lang"), F.when(F.col("id") % 10 > 0, "big").otherwise(F.concat(F.lit("s"), (F.col("id") % 700).cast("string"))).alias("source"),
        F.col("id").alias("n_chars"))
    assert sum(same_manifest(docs).values()) == 5000


def test_manifest_with_repeated_and_null_ids(spark):
    docs = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 3 == 1, 77).otherwise(F.col("id") % 500)).cast("bigint").alias("doc_id"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("T"), (F.col("id") % 60).cast("string"))).alias("text"),
        F.lit(None).cast("string").alias("lang"), F.when(F.col("id") % 5 > 0, "a").alias("source"), F.lit(None).cast("bigint").alias("n_chars"))
    assert sum(same_manifest(docs).values()) == 3000


def test_manifest_on_odd_rows(odd, clashing):
    same_manifest(odd)
    same_manifest(odd.withColumns({"Leaf": F.lit(1), "ROOT": F.lit("x"), "tree": F.lit(2), "id": F.lit(3), "place": F.lit(4), "path": F.array(F.lit(1))}))
    found = merkle.manifest(clashing)
    assert found.count() == len(ODD) and "slot" in found.columns
    assert merkle.manifest(odd.limit(0)).collect() == []
    same_manifest(odd.filter("doc_id = 3"))


# Alignment


def plain_alignment(texts):
    from tokenizers import Tokenizer
    import sentencepiece

    file_a, file_b = alignment.default_files()
    a, b = Tokenizer.from_file(file_a), sentencepiece.SentencePieceProcessor(model_file=file_b)
    a.encode_special_tokens = True
    table = alignment.byte_values()

    def piece(i):
        text = b.id_to_piece(i)
        return bytes([int(text[3:5], 16)]) if re.fullmatch("<0x[0-9A-F]{2}>", text) else text.replace("▁", " ").encode()

    per, counts = [], Counter()
    for text in texts:
        ids_a = a.encode(" " + (text or ""), add_special_tokens=False).ids
        ids_b = b.encode(text or "")
        parts_a = [bytes(table[c] for c in a.id_to_token(i)) for i in ids_a]
        parts_b = [piece(i) for i in ids_b]
        whole = b" " + (text or "").encode()
        if not text or b"".join(parts_a) != whole or b"".join(parts_b) != whole:
            per.append((0, 0, 0, [], ""))
            continue
        ends_a = dict(zip(np.cumsum([len(x) for x in parts_a]).tolist(), ids_a))
        ends_b = dict(zip(np.cumsum([len(x) for x in parts_b]).tolist(), ids_b))
        groups, links, now_a, now_b = [], [], [], []
        for end in range(1, len(whole) + 1):
            now_a += [ends_a[end]] if end in ends_a else []
            now_b += [ends_b[end]] if end in ends_b else []
            if end in ends_a and end in ends_b:
                links.append((ends_a[end], ends_b[end]))
                groups.append(",".join(map(str, now_a)) + "|" + ",".join(map(str, now_b)))
                now_a, now_b = [], []
        counts.update(links)
        per.append((len(ids_a), len(ids_b), len(groups), links, sha(";".join(groups))))
    best = Counter()
    for (_, y), n in counts.items():
        best[y] = max(best[y], n)
    return [(n_a, n_b, groups, len(links), sum(counts[x] == best[x[1]] for x in links), sum(counts[x] for x in links), digest)
            for n_a, n_b, groups, links, digest in per]


STRANGE = ["a", " a", "a  b\n\n c\t", "<s> </s> <|endoftext|> <unk> <0x41>", "▁ under", "héllo ñandú 日本語 🤖 é", "\x00\x01​", "don't can't 123456 1,000.50",
           " " * 50 + "x", "\r\n\r\n", None, "", "naïve café — “quotes”", "ends in a space ", " begins with one", " ", "\n", "\tx y", "﻿mark"]


def test_op13(spark):
    docs = {row.doc_id: row.text for row in read(spark, SMALL, "documents").select("doc_id", "text").collect()}
    expected = dict(zip(docs, plain_alignment(docs.values())))
    got = {row.doc_id: tuple(row)[1:] for row in queries.op13_tokenizer_alignment(spark, SMALL).select("doc_id", *alignment.RESULTS).collect()}
    assert got == expected and sum(x[3] for x in got.values()) > 0


@pytest.mark.parametrize("table_rows", [0, 40, alignment.TABLE_ROWS])
def test_alignment_of_odd_texts(documents, table_rows):
    texts = [*STRANGE, *STRANGE[:4], LONG[:30_000], *[row[1] for row in ODD if row[1] != LONG]]
    found = alignment.align_tokenizers(documents(*enumerate(texts)).repartition(3), table_rows=table_rows).collect()
    expected = plain_alignment(texts)
    assert {row.doc_id: tuple(getattr(row, name) for name in alignment.RESULTS) for row in found} == dict(enumerate(expected))


def test_chunks_are_cut_where_both_tokenizers_cut(monkeypatch):
    text = " ".join(STRANGE[i % 10] + " and  then some\n words\u3000 follow \t here" for i in range(60)).replace("▁", "")
    for each in (text, " " + text, "\n x", "x ", "  ", "plain words only"):
        assert "".join(" " + key for key in alignment.chunks(each)) == " " + each
    pair = alignment.Pair.at(alignment.default_files())
    found = [[row[:3] for row in alignment.align_texts(pair, [text, "", "short one", text])]]
    monkeypatch.setattr(alignment, "RUN", 50)
    monkeypatch.setattr(alignment, "CHUNKS", 30)
    found.append([row[:3] for row in alignment.align_texts(pair, [text, "", "short one", text])])
    assert found[0] == found[1]
    assert found[0] == [(row[0], row[1], row[6]) for row in plain_alignment([text, "", "short one", text])]
    pair.forget()


def test_pointer_doubling_finds_groups():
    draw = np.random.default_rng(2)
    for _ in range(200):
        n = int(draw.integers(1, 60))
        ends_a, ends_b = (np.append(np.flatnonzero(draw.random(n - 1) < 0.5) + 1, n) for _ in range(2))
        shared = np.intersect1d(ends_a, ends_b)
        of_a, of_b = alignment.terminal_tokens(ends_a, ends_b)
        for ends, of in ((ends_a, of_a), (ends_b, of_b)):
            assert (ends_b[of] == shared[np.searchsorted(shared, ends)]).all()


def test_alignment_and_secrets_keep_other_columns(odd, clashing):
    for apply, results in ((alignment.align_tokenizers, alignment.RESULTS), (secret_scan.find_secrets, ("secrets",))):
        for docs in (odd, clashing.withColumns({"N_Links": F.lit(1), "Secrets": F.lit("x"), "links": F.lit(2), "__row": F.lit(3)})):
            found = apply(docs)
            names = [name.lower() for name in found.columns]
            assert len(set(names)) == len(names) and set(results) <= set(found.columns)
            assert len(found.collect()) == len(ODD) and {"doc_id", "text", "lang", "source", "n_chars"} <= set(found.columns)
        assert apply(odd.limit(0)).collect() == []
