"""The registered queries on the small tables, against plain Python or the library that defines the result."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from tests.compare import database, differences
from tests.conftest import SMALL
from tillframe.llm import decontaminate, jaccard, lm, packing, pii, queries, rules, tokens
from tillframe.llm.common import read


@pytest.fixture(scope="module")
def texts(spark):
    return dict(read(spark, SMALL, "documents").select("doc_id", "text").collect())


def run(spark, name):
    return {row.doc_id: row for row in queries.QUERIES[name](spark, SMALL).collect()}


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def letters(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))


def blanks(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def test_everything_is_registered():
    names = list(entry.queries())
    for n in range(1, 11):
        assert len([name for name in names if name.startswith(f"op{n}_")]) == 1
    assert "pipeline" in names and 4 <= len(corpus_pipeline.STAGES) <= 5


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_same_rows_as_sql(spark, name):
    assert differences(queries.QUERIES[name](spark, SMALL), database(SMALL), queries.ORACLE_SQL[name]) == []


def test_op2(spark, texts):
    windows = defaultdict(set)
    for item, text in read(spark, SMALL, "benchmark").collect():
        words = letters(text)
        for k in range(max(1, len(words) - 9)) if words else ():
            windows[tuple(words[k:k + 10])].add(str(item))
    found = run(spark, "op2_benchmark_decontamination")
    assert any(row.contaminated for row in found.values()) and len(found) == len(texts)
    documents, benchmark = (read(spark, SMALL, name) for name in ("documents", "benchmark"))
    spans = dict(decontaminate.find_contamination(documents, benchmark).select("doc_id", "spans").collect())
    for doc, text in texts.items():
        words, hit, items = letters(text), set(), set()
        for size in {len(w) for w in windows}:
            for k in range(len(words) - size + 1):
                if tuple(words[k:k + size]) in windows:
                    hit |= set(range(k, k + size))
                    items |= windows[tuple(words[k:k + size])]
        row = found[doc]
        assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (len(words), len(hit), len(items), bool(hit))
        assert row.items_sha256 == hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()
        assert {i for a, b in spans[doc] for i in range(a, b)} == hit


def test_op3(spark, texts):
    found = run(spark, "op3_min_cost_flow_sharding")
    shards = defaultdict(list)
    for doc, text in texts.items():
        row = found[doc]
        assert (row.size, row.text_crc32, row.law, row.grown_shard) == (len(text.encode()) + 8, zlib.crc32(text.encode()), "bytes", None)
        shards[row.shard].append(row)
    assert sorted(shards) == list(range(24))
    sizes = [sum(row.size for row in rows) for rows in shards.values()]
    assert max(sizes) - min(sizes) <= max(len(t.encode()) for t in texts.values()) and max(sizes) < 1.1 * sum(sizes) / 24
    assert all(sorted(row.slot for row in rows) == list(range(len(rows))) for rows in shards.values())


def test_op4(spark, texts):
    found = run(spark, "op4_decision_list_rules")
    for doc, text in texts.items():
        words, row = blanks(text), found[doc]
        lines = [line for line in text.split("\n") if blanks(line)]
        triples = Counter(zip(words, words[1:], words[2:]))
        covered = {i + j for i in range(len(words) - 2) if triples[tuple(words[i:i + 3])] > 1 for j in range(3)}
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))
        assert row.base_failed == (len(words) < 50 or 100 * len(covered) > 50 * len(words)) and not (row.base_failed and row.kept)


def test_rules_are_learned_and_precise(spark):
    docs = spark.range(3000).select(
        F.col("id").alias("doc_id"), (F.col("id") % 5 == 0).alias("bad"),
        F.when(F.col("id") % 5 == 0, F.repeat(F.lit("### buy "), 70)).otherwise(F.concat_ws(" ", F.transform(
            F.sequence(F.lit(1), F.lit(80)), lambda i: F.concat(F.lit("w"), (F.col("id") * i % 97).cast("string"))))).alias("text"))
    statistics = rules.text_statistics(docs).drop("text")
    learned = rules.learn(statistics, F.col("bad"))
    assert learned.rules and all(rule.good == 0 for rule in learned.rules)
    assert rules.judge(statistics, learned).filter("(rule is not null) <> bad").count() == 0


def test_op5(spark, texts):
    model = tokens.Pieces.at(tokens.default_model()).model
    found = run(spark, "op5_token_counts")
    for doc, text in texts.items():
        n = len(model.encode(text))
        assert (found[doc].n_bytes, found[doc].n_tokens, found[doc].over_limit) == (len(text.encode()), n, n > 4096)
    lengths = tokens.Lengths({}, tokens.Pieces.at(tokens.default_model()))
    for odd in ("", " ", "  a", "a \n b", "\n\n", "▁a ▁b", "<s> x</s>", "\ta", "a" * 500, "é日​", "\x00", " \n", "x\n", "a  \n  b  "):
        assert tokens.count_tokens(odd, lengths) == len(model.encode(odd))


def test_op6(spark, texts):
    sets = {}
    for doc, text in texts.items():
        words = letters(text)
        sets[doc] = frozenset(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else None
    links = {a: {b for b, y in sets.items() if a != b and x and y and len(x & y) / len(x | y) >= 0.8} for a, x in sets.items()}
    group = {doc: doc for doc in texts}
    for _ in texts:
        for a, others in links.items():
            group[a] = min([group[a], *(group[b] for b in others)])
    found = run(spark, "op6_ngram_jaccard_join")
    assert {doc: row.n_links for doc, row in found.items()} == {doc: len(others) for doc, others in links.items()}
    assert {doc: row.class_id for doc, row in found.items()} == group
    kept = jaccard.one_of_each(read(spark, SMALL, "documents"))
    assert {row.doc_id for row in kept.select("doc_id").collect()} == set(group.values())


@pytest.mark.parametrize("name, size", [("BLOCK", 16), ("BLOCK_GRAMS", 400)])
def test_links_across_blocks(spark, documents, monkeypatch, name, size):
    """A group of near copies over several blocks: the same counts as from pairs."""
    monkeypatch.setattr(jaccard, name, size)
    base = [f"word{i}" for i in range(200)]
    docs = documents(*[(i, " ".join(base[:i % 190] + [f"new{i}"] + base[i % 190 + 1:])) for i in range(100)])
    found = jaccard.near_copies(docs).collect()
    assert {(row.class_id, row.n_links, row.n_linked_classes) for row in found} == {(0, 99, 99)}


def test_op7(spark, texts):
    model = tokens.Pieces.at(tokens.default_model())
    packed = packing.pack(read(spark, SMALL, "documents"), length=512, group_tokens=100_000).collect()
    matrix = packing.matrix([row.ids for row in packed], model.size)
    got = defaultdict(dict)
    for row, ids in zip(packed, matrix):
        places = packing.positions(row.position_resets, 512)
        assert row.cu_seqlens[-1] == row.n_tokens <= 512 and (ids[row.n_tokens:] == packing.PAD).all()
        for k, (doc, segment) in enumerate(zip(row.doc_ids, row.segments)):
            a, b = row.cu_seqlens[k:k + 2]
            got[doc][segment] = ids[a:b].tolist()
            assert places[a:b].tolist() == list(range(b - a))
    for doc, text in texts.items():
        assert [i for s in sorted(got[doc]) for i in got[doc][s]] == [*model.model.encode(text), model.end]
    report = queries.QUERIES["op7_best_fit_packing"](spark, SMALL).collect()
    assert sum(row.n_tokens for row in report) == sum(row.n_tokens for row in packed)


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    return sum((2 * int(c) - 9 * (int(c) > 4)) if i % 2 else int(c) for i, c in enumerate(reversed(digits))) % 10 == 0


def entities(text):
    found = []
    for rank, (kind, pattern) in enumerate(PATTERNS.items()):
        for match in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", match[0])
            if {"email": lambda: True, "ip": lambda: all(int(x) <= 255 for x in match[0].split(".")),
                    "card": lambda: 14 <= len(digits) <= 19 and luhn(digits), "phone": lambda: 10 <= len(digits) <= 15}[kind]():
                found.append((match.start(), rank, match.end(), kind))
    return sorted(found)


def same_entities(found, texts):
    for doc, text in texts.items():
        expected = entities(text or "")
        spans = ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in expected)
        row = found[doc]
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(e[3] == kind for e in expected) for kind in PATTERNS]
        assert row.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert set(filter(None, spans.split(","))) <= set(row.spans.split(","))


def test_op8(spark, texts):
    same_entities(run(spark, "op8_bootstrapped_pii"), texts)


def test_op8_odd_texts(spark, documents):
    odd = ["a@b.com_x@y.z a@b..c 1.2.3.4.5.6.7.8 256.1.1.1 007.1.1.1", None, "", "4111 1111 1111 1111 4111-1111-1111-1111 +1 (017) 555-1234 +12",
           "日本 x@é.de ü@b.de 12 34 5678 " * 3, "1" * 50 + " " + "9.9.9.9" * 3 + " 99999999999999999999.1.1.1", "a" * 50_000 + "@", "%+-@a.b@c.d",
           "1.1.1.1 " * 300]
    found = {row.doc_id: row for row in pii.entity_report(documents(*enumerate(odd))).collect()}
    same_entities(found, dict(enumerate(odd)))


def test_contexts_discover_identifiers(spark, documents):
    cards = [n for n in range(4 * 10**15, 4 * 10**15 + 400) if luhn(str(n))][:12]
    docs = documents(*[(i, f"my card number: {n} ok") for i, n in enumerate(cards)], (50, "old card number: 4000000000000001, gone"), (51, "room 12"))
    spans = {row.doc_id: row.spans for row in pii.entity_report(docs).collect()}
    assert spans[50] == "card:17:33" and spans[51] == ""


def plain_discovery(texts, settings):
    """Spans by document: base entities and those that patterns discover, with dictionaries in place of joins."""
    n, occurrences, edges, spans = len(PATTERNS), [], {}, {}
    for doc, text in texts.items():
        base = [entity[:3] for entity in entities(text)]
        spans[doc] = {(a, rank, b) for a, rank, b in base}
        found = list(re.finditer(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D]*[0-9][^\x20\x09-\x0D]*", text))
        for i, match in enumerate(found):
            gaps = text[found[i - 1].end() if i else 0:match.start()], text[match.end():found[i + 1].start() if i + 1 < len(found) else len(text)]
            before, after = (re.sub(r"[\x09-\x0D]", " ", gap).strip(" ").lower().split(" ") for gap in gaps)
            core = match[0].strip(pii._EDGE)
            start = match.end() - len(match[0].lstrip(pii._EDGE))
            end = start + len(core)
            inside = [(a, rank) for a, rank, _ in base if start - 1 <= a < end]
            rank = min(inside)[1] if inside else None
            if rank is None and any(a < end and b > start for a, _, b in base) or not any(map(str.isalpha, before[-1])):
                continue
            shape = re.sub("[0-9]+", "9", re.sub("[0-9]{10,}", "L", re.sub("[A-Za-z]+", "a", core)))
            patterns = {(before[-1], shape), (" ".join(before[-2:]), shape)} | ({(before[-1], shape, after[0])} if any(map(str.isalpha, after[0])) else set())
            occurrences.append((doc, start, end, rank, patterns))
            for pattern in patterns:
                seeds = edges.setdefault((pattern, core.lower()), [0.0] * n)
                if rank is not None:
                    seeds[rank] = 1.0
    seeds, members = defaultdict(lambda: [0.0] * n), defaultdict(list)
    for (pattern, instance), flags in edges.items():
        seeds[instance] = [max(x) for x in zip(seeds[instance], flags)]
        members[pattern].append(instance)
    scores = dict(seeds)
    for _ in range(settings.rounds):
        sums = {pattern: [sum(scores[x][k] for x in found) for k in range(n)] for pattern, found in members.items()}
        trust = {pattern: [x / len(members[pattern]) for x in total] for pattern, total in sums.items()}
        gains = defaultdict(lambda: [0.0] * n)
        for pattern, instance in edges:
            gains[instance] = [gain + math.log1p(-min(trust[pattern][k], 0.999) * (sums[pattern][k] >= settings.min_seeds)) for k, gain in enumerate(gains[instance])]
        scores = {x: seeds[x] if max(seeds[x]) else [1 - math.exp(gain) for gain in gains[x]] for x in seeds}
    named = {}
    for pattern, each in trust.items():
        rank = each.index(max(each))
        if each[rank] >= settings.min_confidence and sum(edges[pattern, x][rank] for x in members[pattern]) >= settings.min_seeds:
            named[pattern] = rank
    for doc, start, end, rank, patterns in occurrences:
        ranks = [named[pattern] for pattern in patterns if pattern in named]
        if rank is None and ranks:
            spans[doc].add((start, min(ranks), end))
    return {doc: ",".join(f"{list(PATTERNS)[rank]}:{a}:{b}" for a, rank, b in sorted(found)) for doc, found in spans.items()}


def test_discovered_spans_against_plain_bootstrapping(documents):
    """Contexts that name cards, hosts and telephones, some of them shared with codes and room numbers."""
    draw = np.random.default_rng(12)
    texts = {}
    for i in range(400):
        cue = ["card number:", "paid with card", "host address", "call me under", "room", "order code"][draw.integers(6)]
        number = str(draw.integers(10**14, 10**15))
        valid = next(number + str(d) for d in range(10) if luhn(number + str(d)))
        broken = number + str((int(valid[-1]) + 3) % 10)
        real = draw.random() < 0.93
        value = {"card number:": valid if real else broken, "paid with card": valid if real else broken,
                 "host address": f"10.0.{i % 250}.7" if real else f"10.0.{i}.999", "call me under": f"+1-555-{1000000 + i}" if real else f"01555{1000000 + i}",
                 "room": str(i % 40), "order code": broken if real else valid}[cue]
        texts[i] = f"Word {cue} {value}{' thanks' if i % 3 else ', bye'} and more 日本 {'x9y' if i % 5 else ''}"
    for settings in (pii.Bootstrap(), pii.Bootstrap(2, 0.6, 3)):
        rows = pii.find_entities(documents(*texts.items()), settings=settings).select("doc_id", pii.span_text(F.col("spans")).alias("spans")).collect()
        assert dict(rows) == (expected := plain_discovery(texts, settings))
        base = {doc: ",".join(f"{kind}:{a}:{b}" for a, _, b, kind in entities(text)) for doc, text in texts.items()}
        more = [doc for doc in texts if expected[doc] != base[doc]]
        assert more and not any("order code" in texts[doc] or " room " in texts[doc] for doc in more)


def test_repeated_windows_are_compared_by_words(spark):
    """Few words, many windows: counts equal those of plain Python, also where nearly all windows repeat."""
    draw = np.random.default_rng(3)
    texts = {i: " ".join(draw.choice(["a", "bb", "a b", "c\td", "é"], size)) for i, size in enumerate((0, 1, 2, 3, 4, 9, 40, 300, 3000))}
    rows = rules.text_statistics(spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")).collect()
    for row in rows:
        words = blanks(texts[row.doc_id])
        triples = Counter(zip(words, words[1:], words[2:]))
        assert row.n_repeat_words == len({i + j for i in range(len(words) - 2) if triples[tuple(words[i:i + 3])] > 1 for j in range(3)})


@pytest.mark.parametrize("chunk_tokens", [lm.CHUNK_TOKENS, 700])
def test_op9(spark, texts, chunk_tokens):
    scores, mixture = lm.score(read(spark, SMALL, "documents"), chunk_tokens=chunk_tokens)
    found = {row.doc_id: row for row in scores.collect()}
    streams = {doc: [*blanks(lower(text)), None] for doc, text in texts.items()}
    one, two = Counter(), Counter()
    for doc, stream in streams.items():
        if zlib.crc32(str(doc).encode()) % 5 != 1:
            one.update(stream)
            two.update(zip([None, *stream], stream))
    n, v = sum(one.values()), len(one)
    assert (mixture.tokens, mixture.distinct) == (n, v) and np.allclose(mixture.weights.sum(axis=1), 1)
    for doc, stream in streams.items():
        row = found[doc]
        assert (row.n_tokens, row.n_known, row.train_tokens) == (len(stream), sum(one[w] > 0 for w in stream), n)
        assert row.base_score == pytest.approx(sum(math.log10((one[w] + 0.5) / (n + 0.5 * (v + 1))) for w in stream), rel=1e-9)
        total = 0.0
        for context, word in zip([None, *stream], stream):
            a, b, d = mixture.weights[int(math.log2(one[context] + 1))]
            total += math.log10(a * two[context, word] / max(1, one[context]) + b * one[word] / n + d / (v + 1))
        assert row.score == pytest.approx(total, rel=1e-9)
    held = [row for doc, row in found.items() if zlib.crc32(str(doc).encode()) % 5 == 1]
    assert sum(row.score for row in held) > sum(row.base_score for row in held)


def test_op10(spark):
    found = run(spark, "op10_language_id")
    langs = dict(read(spark, SMALL, "documents").select("doc_id", "lang").collect())
    held = [doc for doc in langs if zlib.crc32(str(doc).encode()) % 4 == 2]
    assert {doc for doc, row in found.items() if row.held_out} == set(held)
    assert np.mean([found[doc].lang_pred == langs[doc] for doc in held]) >= 0.95
    assert all(0 <= row.score <= 1 for row in found.values())


def test_pipeline(spark, texts):
    """Every stage on its own input: languages kept, one of each group, no passage left, a sample, whole shards."""
    docs = read(spark, SMALL, "documents")
    for name, stage in corpus_pipeline.STAGES[:3]:
        after = stage(spark, docs, SMALL).cache()
        if name == "near copies":
            assert after.count() == jaccard.near_copies(docs).select("class_id").distinct().count()
        docs = after
    windows = set()
    for _, text in read(spark, SMALL, "benchmark").collect():
        words = letters(text)
        windows |= {tuple(words[k:k + 10]) for k in range(max(1, len(words) - 9))}
    left = {row.doc_id: row for row in docs.collect()}
    cut = 0
    for doc, row in left.items():
        words = letters(row.text)
        assert not any(tuple(words[k:k + 10]) in windows for k in range(len(words))) and row.n_chars == len(row.text)
        cut += row.text != texts[doc]
    assert cut > 0
    found = entry.queries()["pipeline"](spark, SMALL).collect()
    assert {row.doc_id for row in found} <= set(left) and all(row.text == left[row.doc_id].text for row in found)
