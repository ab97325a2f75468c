from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest

from docweir.llm import language_id, licences, near_dedup, toxicity
from docweir.llm.components import components
from tests.llm.conftest import LONG, ROWS, row


def shingles(text, width):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1)) if len(words) >= width else frozenset([tuple(words)] if words else [])


def brute(rows, width):
    """Components by comparing all pairs."""
    sets = [shingles(r[1], width) for r in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        least[find(i)].append(r[0])
    out = []
    for i, r in enumerate(rows):
        ids = [x for x in least[find(i)] if x is not None]
        out.append((r[0], len(sets[i]), min(ids) if ids and sets[i] else r[0]))
    return sorted(out, key=repr)


def got(frame):
    rows = frame.collect()
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=repr)


@pytest.mark.parametrize("width", [2, 5])
def test_awkward_rows(edge, width):
    assert got(near_dedup.near_duplicates(edge, width=width)) == brute(ROWS, width)


def variants(rng, count, edits, size=60):
    """Copies of one text with some words changed: similar to a few, and not to most, of the others."""
    base = [f"w{i}" for i in range(size)]
    for i in range(count):
        words = list(base)
        for _ in range(rng.randint(*edits)):
            words[rng.randrange(size)] = f"x{rng.randrange(10_000)}"
        yield " ".join(words)


def test_crowded_buckets_lose_no_link(spark, edge, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 8)
    monkeypatch.setattr(near_dedup, "BLOCK", 6)
    rng = random.Random(8)
    rows = [row(i, t) for i, t in enumerate(variants(rng, 160, (0, 9)))] + [row(500 + i, " ".join(rng.choice("abcdefgh") * 3 for _ in range(30))) for i in range(60)]
    assert got(near_dedup.near_duplicates(spark.createDataFrame(rows, edge.schema), width=2)) == brute(rows, 2)


def test_crowded_buckets_without_a_link_leave_nobody_out(spark, edge, monkeypatch):
    """Two twins and a stranger meet in one bucket only: whoever is its pivot or has its largest label, the twins are linked."""
    monkeypatch.setattr(near_dedup, "SMALL", 2)
    rng = np.random.default_rng(9)
    rows, signatures = [], []
    for group in range(40):
        text = [f"g{group}w{i}" for i in range(60)]
        one, stranger = rng.integers(0, 1 << 16, (2, near_dedup.HASHES)).astype("<u2")
        two = one.copy()
        two[4::4] ^= 1  # one hash of every band but the first
        stranger[:4] = one[:4]
        for words, signature in ((text, one), ([*text[:30], "other", *text[31:]], two), ([f"g{group}x{i}" for i in range(60)], stranger)):
            signatures.append((len(rows), signature.tobytes()))
            rows.append(row(len(rows), " ".join(words)))
    plain, given = near_dedup.signed, spark.createDataFrame(signatures, "id long, sig binary")
    monkeypatch.setattr(near_dedup, "signed", lambda *x: plain(*x).drop("sig").join(given, "id"))
    assert got(near_dedup.near_duplicates(spark.createDataFrame(rows, edge.schema), width=2)) == brute(rows, 2)


def test_empty_table(nothing):
    assert near_dedup.near_duplicates(nothing).count() == 0


def test_least_matches_follow_the_posterior():
    least = near_dedup.least_matches(80, 1e-5)
    assert list(least) == sorted(least) and least[-1] < 0.8 * near_dedup.HASHES
    rng = np.random.default_rng(2)
    same = rng.random((20_000, near_dedup.HASHES)) < 0.8
    x = np.arange(len(same))
    kept = near_dedup.plausible(np.vstack([np.where(same, 1, 2), np.ones((1, near_dedup.HASHES), int)]), x, np.full(len(x), len(x)), 80, 1e-5)
    assert kept.mean() > 0.999
    far = rng.random((2000, near_dedup.HASHES)) < 0.5
    x = np.arange(len(far))
    assert near_dedup.plausible(np.vstack([np.where(far, 1, 2), np.ones((1, near_dedup.HASHES), int)]), x, np.full(len(x), len(x)), 80, 1e-5).mean() < 0.01


def test_signatures_estimate_similarity():
    memo = near_dedup._Words()
    a, b = (near_dedup.shingles([f"w{i}".encode() for i in range(lo, lo + 900)], 2, memo) for lo in (0, 100))
    x, y = (np.frombuffer(near_dedup.signature(s), "<u2") for s in (a, b))
    assert abs((x == y).mean() - 799 / 999) < 0.15


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (5, 5)], "a bigint, b bigint")
    assert {r.node: r.label for r in components(edges).collect()} == {**{i: 0 for i in range(61)}, 100: 100, 101: 100}
    assert components(edges.limit(0)).count() == 0


TEXTS = {
    "en": "the quick brown fox jumps over the lazy dog and then the other thing that they were thinking with",
    "de": "der schnelle braune Fuchs springt über den faulen Hund und dann auch noch einmal über die Wiese",
    "fr": "le renard brun et rapide saute par dessus le chien paresseux et puis encore une fois dans la rivière",
}


@pytest.fixture(scope="module")
def profiles(spark, edge):
    rng = random.Random(1)
    rows = [row(i, " ".join(rng.choices(TEXTS[lang].split(), k=40)), lang) for i, lang in enumerate(list(TEXTS) * 40)] + [row(900, None, "en"), row(901, "text", None)]
    return language_id.learn_profiles(spark.createDataFrame(rows, edge.schema))


def test_languages(spark, edge, profiles):
    assert set(profiles) == set(TEXTS)
    rows = [row(i, t) for i, t in enumerate(TEXTS.values())]
    found = language_id.predict(spark.createDataFrame(rows, edge.schema), profiles).orderBy("doc_id").collect()
    assert [r.lang_pred for r in found] == list(TEXTS) and all(0 < r.lang_score <= 1 for r in found)


def test_awkward_languages(edge, nothing, profiles):
    found = language_id.predict(edge, profiles)
    assert found.columns == [*edge.columns, "lang_pred", "lang_score"]
    rows = found.collect()
    assert len(rows) == len(ROWS)
    assert all((r.lang_pred == "und") == (not any(c.isalpha() for c in r.text or "")) and r._dw_open == "e" for r in rows)
    assert language_id.predict(nothing, profiles).count() == 0
    assert {r.lang_pred for r in language_id.predict(edge, {}).collect()} == {"und"}
    assert language_id.learn_profiles(nothing) == {}


def test_out_of_place_distance_by_hand():
    grams, counts = language_id.gram_counts("aab")
    assert counts.sum() == 3 + 4 + 3  # a, a, b; _a, aa, ab, b_; _aa, aab, ab_
    ranks = language_id.ranked(grams, counts)
    profile = (np.sort(ranks), np.argsort(np.argsort(ranks)).astype(int))
    order = {g: i for i, g in enumerate(ranks.tolist())}
    by_hand = (np.array(sorted(order)), np.array([order[g] for g in sorted(order)]))
    assert language_id.distance(ranks, by_hand) == 0
    assert language_id.distance(ranks[::-1], by_hand) == sum(abs(i - (len(ranks) - 1 - i)) for i in range(len(ranks)))
    assert language_id.distance(np.array([1, 2]), by_hand) == 2 * language_id.PROFILE
    assert len(profile[0]) == len(ranks)


def run(words, learned={"scum": 5.0}):
    return dict(zip(toxicity.EVENTS, toxicity.events(words, toxicity.Lexicon(learned), toxicity.machine()).tolist()))


def test_grammar_tells_clauses_apart():
    assert run("scum here.")["bare"] == 5
    assert run("you are scum.")["direct"] == 5
    assert run("you there. scum!")["bare"] == 5
    assert run("you are not scum.")["negated"] == 5
    assert run("not at all what one calls scum.")["negated"] == 0
    assert run("he said you are scum.")["reported"] == 5
    assert run("he said so. you are scum.")["direct"] == 5
    assert run("they will hurt you")["threat"] == 1 and run("hurt them")["threat"] == 0
    assert sum(run("")[e] for e in toxicity.EVENTS) == 0


def test_composition_is_one_machine_after_the_other():
    rng = random.Random(4)
    both = toxicity.compose(toxicity.negation(), toxicity.reported(), "oIVPNR")
    one, two = toxicity.negation(), toxicity.reported()
    a, b, c = one.start, two.start, both.start
    for _ in range(500):
        symbol = rng.choice("oIVPNR")
        a, middle = one.step(a, symbol)
        b, out = two.step(b, middle)
        c, same = both.step(c, symbol)
        assert same == out


def test_learning_finds_the_lexicon(spark, edge, nothing):
    rng = random.Random(2)
    vocabulary = [f"word{i}" for i in range(300)]
    rows, labels = [], []
    for i in range(600):
        toxic = int(i % 4 == 0)
        words = rng.choices(vocabulary, k=30) + (["vermin", f"grubby{i % 50}"] if toxic else [])
        rng.shuffle(words)
        rows.append(row(i, " ".join(words)))
        labels.append((i, toxic))
    docs, truth = spark.createDataFrame(rows, edge.schema), spark.createDataFrame([*labels, (None, 1), (7, None), (9, 5)], "doc_id bigint, toxic int")
    model = toxicity.learn(docs, truth)
    assert any(f.startswith("ver") for f in model.learned) and any(f.startswith("gru") for f in model.learned)
    scores = {r.doc_id: r.toxicity for r in toxicity.score(docs, model).collect()}
    assert all((scores[i] >= toxicity.THRESHOLD) == bool(t) for i, t in labels)
    awkward = toxicity.score(edge, model)
    assert awkward.columns == [*edge.columns, "toxicity"] and all(0 <= r.toxicity < 0.5 for r in awkward.collect())
    assert toxicity.score(nothing, model).count() == 0
    assert toxicity.learn(docs, truth.where("toxic = 1")).learned == {} and toxicity.learn(nothing, truth.limit(0)).learned == {}


def best_common(template, words):
    table = np.zeros((len(template) + 1, len(words) + 1), int)
    for i, a in enumerate(template):
        for j, b in enumerate(words):
            table[i + 1, j + 1] = max(table[i, j] + (a == b), table[i, j + 1], table[i + 1, j])
    return int(table[-1, -1])


def test_alignment_equals_the_full_table():
    rng = np.random.default_rng(6)
    for _ in range(30):
        template = rng.integers(0, 12, 25)
        text = np.delete(template, rng.integers(0, 25, 4))
        text = np.insert(text, rng.integers(0, 20, 3), rng.integers(0, 12, 3))
        found = licences.align(template, text, 0, 25)
        assert found[0] == best_common(template, text) and 0 <= found[1] <= found[2] < len(text)
    assert licences.align(np.array([1, 2]), np.array([3, 4]), 0, 2) is None


def test_winnowing_marks_every_window():
    rng = np.random.default_rng(7)
    hashes = rng.integers(0, 50, 400).astype(np.uint64)
    marks = licences.winnow(hashes, 3)
    for i in range(len(hashes) - 2):
        window = hashes[i : i + 3]
        assert any(i <= m < i + 3 and hashes[m] == window.min() for m in marks)


def test_licences_are_found_with_their_spans(spark, edge, nothing):
    mit = licences.TEMPLATES["mit"]
    changed = mit.replace("free of charge", "at no charge").replace("sublicense, ", "")
    texts = [f"Intro Ünïcode {mit} end", f"x {changed} y", "All rights reserved.", "All rights are mine.", "Released under the\n MIT   License. Licensed under CC BY-NC 4.0.", (LONG + " ") + licences.TEMPLATES["isc"], None, ""]
    rows = [row(i, t) for i, t in enumerate(texts)]
    found = defaultdict(dict)
    for r in licences.scan(spark.createDataFrame(rows, edge.schema)).collect():
        found[r.doc_id][r.licence] = r
    one = found[0]["mit"]
    assert one.coverage == 1 and texts[0][one.span_start : one.span_end].startswith("Permission is hereby") and texts[0][one.span_start : one.span_end].endswith("SOFTWARE")
    assert 0.9 < found[1]["mit"].coverage < 1
    assert set(found[2]) == {"all-rights-reserved"} and 3 not in found and 6 not in found and 7 not in found
    assert set(found[4]) == {"mit-line", "cc-by-nc-4.0-line"} and "isc" in found[5]
    assert licences.scan(edge).count() == 0 and licences.scan(nothing).count() == 0


@pytest.mark.parametrize(
    "name, text, spans",
    [
        ("all-rights-reserved", "All rights reserved. Foo Inc. All rights reserved.", ["All rights reserved"] * 2),
        ("all-rights-reserved", "All rights reserved. " * 50, ["All rights reserved"] * 50),
        ("mit-line", "Also available under the MIT terms, see below. Released under the MIT License.", ["Released under the MIT License"]),
        ("mit-line", "Released under the MIT terms. Released under the MIT License.", ["Released under the MIT", "Released under the MIT License"]),
        ("cc-by-nc-4.0-line", "licensed under CC, by name. Licensed under CC BY-NC 4.0. Licensed under CC BY-NC 4.0.", ["Licensed under CC BY-NC 4.0"] * 2),
        ("isc", f"{licences.TEMPLATES['isc']} {licences.TEMPLATES['isc']}", [licences.TEMPLATES["isc"].rstrip(".")] * 2),
    ],
)
def test_repeated_notices_and_decoys(name, text, spans):
    assert [text[m[3] : m[4]] for m in licences.Index(licences.TEMPLATES).matches(text) if m[0] == name] == spans


def test_insults_before_a_target_and_forms_of_threats():
    assert run("scum, that is what you are.")["direct"] == 5
    assert run("scum is here. you are there.")["direct"] == 0
    assert run("they are killing people")["threat"] == 1 and run("you stabbed")["threat"] == 1
    assert toxicity.inflected("stab") == ["stab", "stabs", "stabbed", "stabbing"] and "destroying" in toxicity.inflected("destroy")


def test_rows_that_repeat_are_learned_from_once(spark, edge):
    hot = [row(1, "le le le le le le", "fr")] * 400
    rows = [row(i, " ".join(random.Random(i).choices(TEXTS[lang].split(), k=30)), lang) for i, lang in enumerate(list(TEXTS) * 30, 10)]
    once = language_id.learn_profiles(spark.createDataFrame([*rows, hot[0]], edge.schema))
    often = language_id.learn_profiles(spark.createDataFrame([*rows, *hot], edge.schema))
    assert all((once[lang][0] == often[lang][0]).all() and (once[lang][1] == often[lang][1]).all() for lang in TEXTS)


def test_too_many_languages_are_refused(spark, edge, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_LANGUAGES", 3)
    with pytest.raises(ValueError, match="more than 3 languages"):
        language_id.learn_profiles(spark.createDataFrame([row(i, "text", f"l{i}") for i in range(4)], edge.schema))


def test_repeated_ids_leave_the_toxic_sample_bounded(spark, edge, monkeypatch):
    monkeypatch.setattr(toxicity, "MOST", 1)
    rows = [row(i % 3, f"plain words {i}") for i in range(600)] + [row(100 + i, f"you scum {i}") for i in range(40)]
    labels = spark.createDataFrame([(i, 0, 0) for i in range(3)] + [(100 + i, 0, 1) for i in range(40)], "doc_id long, quality int, toxic int")
    model = toxicity.learn(spark.createDataFrame(rows, edge.schema), labels, sample=50)
    assert model.score(toxicity.events("you scum", toxicity.Lexicon(model.learned), toxicity.machine())) > model.score(toxicity.events("plain", toxicity.Lexicon(model.learned), toxicity.machine()))
