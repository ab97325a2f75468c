from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict

import corpus_pipeline
from docweir.llm import language_id, licences, near_dedup, toxicity
from docweir.llm.catalog import QUERIES
from tests.llm.conftest import LONG, ROWS
from tests.llm.test_exact_and_media import normal
from tests.llm.test_pairs_and_text import brute

NAMES = ["language id", "exact dedup", "near dedup", "mixing", "packing"]


def test_stages_take_effect(spark, small):
    assert [n for n, _ in corpus_pipeline.STAGES] == NAMES and corpus_pipeline.ORACLE_SQL is None
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, kept = docs.columns, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, small).cache()
        assert docs.columns == columns
        kept.append([r.doc_id for r in docs.select("doc_id").collect()])
    whole = spark.read.parquet(f"{small}/documents.parquet").collect()
    assert len(kept[0]) == len(whole)
    assert len(kept[1]) == len({normal(r.text) for r in whole})
    left = [(r.doc_id, r.text) for r in whole if r.doc_id in set(kept[1])]
    assert sorted(kept[2]) == sorted(i for i, _, c in brute(left, 5) if i == c)
    assert set(kept[3]) <= set(kept[2]) and max(Counter(kept[3]).values()) == 2
    final = corpus_pipeline.STAGES[-1][1](spark, docs, small)
    assert Counter(r.doc_id for r in final.where("start = 0").collect()) == Counter(kept[3])


def test_run_gives_the_last_stage(spark, small):
    rows = corpus_pipeline.run(spark, small)
    assert {"doc_id", "sequence_id", "offset", "length"} <= set(rows.columns) and rows.count() > 100


def test_awkward_rows_go_through(spark, edge, nothing):
    docs = edge
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == edge.columns
    ids = [r.doc_id for r in docs.select("doc_id").collect()]
    assert not {3, 4, 5, 11} & set(ids) and {9, 10, 14} & set(ids)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, "").count() == 0


def test_columns_with_the_names_of_verdicts_pass(spark, edge):
    own = ["lang_pred", "lang_score", "toxicity", "digest", "n", "sig", "node", "label", "root", "shard", "slot", "taken", "first_slot", "slots", "licence", "n_bytes", "media", "full_hash", "keep_id", "group_size", "component_id", "n_shingles", "sequence_id", "offset", "piece"]
    docs = edge.select("doc_id", "text", "lang", "source", "n_chars").selectExpr("*", *(f"'own {c}' AS {c}" for c in own))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars", *own]
        rows = docs.collect()
        assert rows and all(r[c] == f"own {c}" for r in rows for c in own)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0


def test_near_copies_of_an_id_go_together(spark, edge):
    rows = [(r[0], r[1]) for r in ROWS]
    kept = corpus_pipeline.near(spark, edge, "").collect()
    found = {}
    for i, _, c in brute(rows, 5):
        found[i] = found.get(i, False) or i == c
    assert sorted(repr(r.doc_id) for r in kept) == sorted(repr(i) for i, _ in rows if found[i])
    assert near_dedup.PERCENT == 80 and LONG


def test_registered_queries_return_every_document(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").count()
    for name in ("op1_ogg_media", "op2_exact_dedup", "op5_mixing", "op6_toxicity", "op7_near_dedup", "op9_sharding", "op10_language_id"):
        assert QUERIES[name](spark, small).select("doc_id").distinct().count() == docs, name
    for name in ("op4_training_order", "op8_packing"):
        assert QUERIES[name](spark, small).select("doc_id").distinct().count() == docs, name
    assert QUERIES["op3_licence_scan"](spark, small).count() > 0


def test_held_out_accuracy(spark, small):
    sf = small.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    found = QUERIES["op10_language_id"](spark, sf).join(docs, "doc_id").where("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in found) > 0.98 * len(found) > 100
    found = QUERIES["op6_toxicity"](spark, sf).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in found) > 0.94 * len(found) > 90


def ngrams(text):
    """(number, gram) of every n-gram of a text, word by word, by plain slices; # is the edge of a word."""
    for word in re.findall(r"[^\W\d_]+", "".join(c if c.isalpha() else " " for c in (text or "").lower())):
        edged = f"#{word}#"
        yield from ((ord(c) | 1 << 61, c) for c in word)
        for n, bit in ((2, 1 << 62), (3, 0)):
            for i in range(len(edged) - n + 1):
                number = 0
                for c in edged[i : i + n]:
                    number = number << 21 | (0 if c == "#" else ord(c))
                yield number | bit, edged[i : i + n]


def profile(texts, size=300):
    counts = Counter(g for t in texts for g in ngrams(t))
    return [g for g, _ in sorted(counts.items(), key=lambda x: (-x[1], x[0][0]))[:size]]


def test_languages_equal_a_plain_version_over_whole_tables(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").collect()
    held = lambda r: zlib.crc32(str(r.doc_id).encode()) % 4 == 2
    known = defaultdict(list)
    for r in docs:
        if r.lang is not None and r.text is not None and not held(r):
            known[r.lang].append(r.text)
    profiles = {lang: {g: i for i, g in enumerate(profile(texts))} for lang, texts in known.items()}
    got = {r.doc_id: r for r in QUERIES["op10_language_id"](spark, small).collect()}
    assert len(got) == len(docs) and language_id.PROFILE == 300
    for r in docs:
        own = profile([r.text])
        far = {lang: sum(abs(p[g] - i) if g in p else 300 for i, g in enumerate(own)) for lang, p in sorted(profiles.items())} if own else {}
        best = min(far, key=far.get, default="und")
        assert (got[r.doc_id].held_out, got[r.doc_id].lang_pred) == (held(r), best)
        assert math.isclose(got[r.doc_id].score, 1 - far[best] / (300 * len(own)) if far else 0.0, abs_tol=1e-12)


def plain_events(text, learned):
    """Events by walking through clauses with plain variables instead of the composed machine."""
    lexicon, names = toxicity.Lexicon(learned), toxicity.EVENTS
    totals, most, tokens = dict.fromkeys(names, 0.0), 0.0, text.lower().split()
    clauses, clause = [], []
    for t in tokens:
        clause.append(lexicon[t][:2])
        if t[-1] in ".!?;:":
            clauses.append(clause)
            clause = []
    if not any(s in (toxicity.INSULT, toxicity.THREAT) for c in [*clauses, clause] for s, _ in c):
        return totals, 0.0, len(tokens)
    for clause in [*clauses, clause]:
        best, since, said, aimed, named, heaviest = {}, 99, False, False, False, 0.0
        for symbol, weight in clause:
            event = None
            negated, since = since < 2, since + 1
            if symbol == toxicity.NEGATION:
                since = 0
            elif symbol == toxicity.REPORT:
                said = True
            elif symbol == toxicity.TARGET:
                event = "direct" if named and not aimed else None
                aimed = True
            elif symbol == toxicity.INSULT:
                heaviest = max(heaviest, weight)
                event = "reported" if said else "negated" if negated else "direct" if aimed else "bare"
                named = named or event in ("bare", "direct")
            elif symbol == toxicity.THREAT:
                event = "reported" if said else "negated" if negated else "threat" if aimed else None
            if event:
                best[event] = max(best.get(event, 0.0), weight or heaviest)
                most = max(most, weight or heaviest)
        for event, weight in best.items():
            totals[event] += weight
    return totals, most, len(tokens)


def test_toxicity_equals_a_plain_version_over_whole_tables(spark, small):
    docs, labels = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/labels.parquet")
    model = toxicity.learn(docs, labels.where(~toxicity.held_out()))
    got = {r.doc_id: r for r in QUERIES["op6_toxicity"](spark, small).collect()}
    rows = docs.collect()
    assert len(got) == len(rows)
    for r in rows:
        totals, most, n = plain_events(r.text or "", model.learned)
        x = [math.log1p(v) for v in (*totals.values(), most, 100 * sum(totals.values()) / (n + 20) if n else 0.0)]
        score = 1 / (1 + math.exp(-(sum(a * b for a, b in zip(x, model.coefficients)) + model.coefficients[-1])))
        assert math.isclose(got[r.doc_id].score, score, rel_tol=1e-9), r.doc_id
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and got[r.doc_id].predicted == int(score >= 0.7)


def test_whole_notices_equal_a_search_over_whole_tables(spark, small):
    """Every place where a template stands word by word is a full match, and every full match is such a place."""
    sf = small.replace("sf0.001", "sf0.01")
    found = QUERIES["op3_licence_scan"](spark, sf).where("coverage = 1").collect()
    got = Counter((r.doc_id, r.licence, r.span_start, r.span_end) for r in found)
    phrases = {name: re.compile(r"(?<![a-zA-Z0-9])" + r"[^a-zA-Z0-9]+".join(re.findall("[a-z0-9]+", text.lower())) + r"(?![a-zA-Z0-9])", re.I | re.A) for name, text in licences.TEMPLATES.items()}
    want = Counter((r.doc_id, name, m.start(), m.end()) for r in spark.read.parquet(f"{sf}/documents.parquet").collect() for name, phrase in phrases.items() for m in phrase.finditer(r.text or ""))
    assert got == want and sum(want.values()) > 20
