"""Language, near copies, decontamination and personal data against plain versions."""

from __future__ import annotations

import hashlib
import os
import random
import re
from collections import Counter

import numpy as np
import pytest

from posmetrics.llm import decontaminate, language, minhash_dedup, personal_data
from tests.conftest import SF_DIR

EMPTY = "doc_id long, text string, lang string"


def frame(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "x", 9) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, spans string, score int").repartition(3)


# --- language -----------------------------------------------------------------------------


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = language.op6_language(spark, "/root/testdata/sf0.01").where("held_out").collect()
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    right = np.mean([r.lang_pred == truth[r.doc_id] for r in found])
    assert len(found) > 100 and right > 0.95
    assert all(0 <= r.score <= 1 for r in found)


def test_language_of_odd_texts(spark):
    rows = [(i, t, lang) for i, (t, lang) in enumerate([("the cat and the dog", "en"), ("le chat et le chien", "fr")] * 4)]
    model = language.train(spark.createDataFrame([*rows, (90, None, "en"), (91, "x", None)], EMPTY))
    assert model.languages == ["en", "fr"]
    docs = frame(spark, [None, "", "12 %%", "the dog and the cat", "le chien", "le chien", "the dog " * 30_000])
    got = {r.doc_id: r for r in language.identify(docs, model).collect()}
    assert [got[i].lang_pred for i in range(7)] == ["und", "und", "und", "en", "fr", "fr", "en"]
    assert got[0].score == 0 and got[4].score == got[5].score
    assert language.identify(docs, model).columns == ["doc_id", "text", "spans", "lang_pred", "score", "ambiguous"]
    nothing = spark.createDataFrame([], EMPTY)
    assert language.identify(nothing, model).count() == 0
    untrained = language.identify(docs, language.train(nothing)).select("lang_pred").distinct().collect()
    assert [r.lang_pred for r in untrained] == ["und"]
    alone = language.train(spark.createDataFrame(rows[:1], EMPTY))
    assert alone.predict(["un", "3"])[0] == ["en", "und"]


def test_fit_does_not_depend_on_hash_seeds():
    """Examples come in an order that strings' hashes, seeded anew in each process, leave alone."""
    import subprocess
    import sys

    code = (
        "from posmetrics.llm.language import fit; import zlib\n"
        "m = fit(['the cat sat on the mat ' * 9, 'le chat est sur le tapis ' * 9, 'der Hund ' * 30], ['en', 'fr', 'de'])\n"
        "print(zlib.crc32(m.weight.tobytes()))"
    )
    seen = {
        subprocess.run([sys.executable, "-c", code], env={**os.environ, "PYTHONHASHSEED": seed}, capture_output=True, text=True, check=True).stdout
        for seed in ("1", "2", "3")
    }
    assert len(seen) == 1 and seen != {""}


@pytest.mark.parametrize("n", [2, 3, 4, 5, 9, 40])
def test_codewords_differ(n):
    code = language.codewords(n)
    assert len({tuple(r) for r in code.tolist()}) == n
    assert (abs(code.sum(0)) < n).all()


# --- near copies --------------------------------------------------------------------------


def bags(texts):
    out = []
    for t in texts:
        words = re.findall(r"[^\W_]+", (t or "").lower())
        runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
        out.append(Counter(runs))
    return out


def plain_classes(texts):
    """Smallest index of every text's class, by comparing all pairs."""
    bag, label = bags(texts), list(range(len(texts)))

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if bag[i] and bag[j]:
                common = sum((bag[i] & bag[j]).values())
                if common / (sum(bag[i].values()) + sum(bag[j].values()) - common) >= 0.8:
                    a, b = root(i), root(j)
                    label[max(a, b)] = min(a, b)
    return [root(i) for i in range(len(texts))]


def changed(words, n, rng):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.random()}"
    return " ".join(words)


def test_near_copies(spark):
    rng = random.Random(4)
    texts = [None, "", "...", "two words", "Two, words!", "two words more", "a b c d e " * 3000, "a b c d e " * 3100]
    for _ in range(12):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(20, 300))]
        texts += [changed(base, rng.randrange(0, 1 + len(base) // 25), rng) for _ in range(rng.randrange(1, 9))]
    got = {r.doc_id: r for r in minhash_dedup.classes(frame(spark, texts)).collect()}
    assert [got[i].class_id for i in range(len(texts))] == plain_classes(texts)
    assert all(r.kept == (r.class_id == r.doc_id) for r in got.values())


def test_chain_of_copies_in_blocks(spark, monkeypatch):
    """Each text is close to the next only; buckets are larger than a block."""
    monkeypatch.setattr(minhash_dedup, "BLOCK", 4)
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    texts = []
    for _ in range(30):
        texts.append(" ".join(words))
        for _ in range(2):
            words[rng.randrange(len(words))] = f"new{rng.random()}"
    got = {r.doc_id: r.class_id for r in minhash_dedup.classes(frame(spark, texts)).collect()}
    assert [got[i] for i in range(len(texts))] == plain_classes(texts)


def test_classes_of_a_corpus(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    got = {r.doc_id: r.class_id for r in minhash_dedup.op5_minhash_dedup(spark, SF_DIR).collect()}
    assert [got[r.doc_id] for r in docs] == [docs[i].doc_id for i in plain_classes([r.text for r in docs])]


def test_one_of_each_stays(spark):
    same = "one two three four five six"
    docs = frame(spark, [same, same, "other text of five words here", None, "x", "x"], [3, 2, 8, 9, None, None])
    docs = docs.unionAll(docs.where("doc_id = 2"))
    assert sorted((r.doc_id or 0, r.spans) for r in minhash_dedup.keep_one(docs).collect()) == [
        (0, "x"),
        (0, "x"),
        (2, "x"),
        (8, "x"),
        (9, "x"),
    ]
    assert minhash_dedup.keep_one(docs.limit(0)).columns == docs.columns
    assert minhash_dedup.classes(docs.limit(0)).count() == 0


def test_registers_agree_as_often_as_multisets_overlap():
    texts = ["a b c d e " * 40, "a b c d e " * 30, "a b c d e " * 10 + "x y z u v " * 20]
    doc, hashes, counts, _ = minhash_dedup.shingles(texts)
    values = minhash_dedup.signatures(doc, hashes, counts, len(texts))
    bag = bags(texts)
    for i, j in ((0, 1), (0, 2), (1, 2)):
        common = sum((bag[i] & bag[j]).values())
        true = common / (sum(bag[i].values()) + sum(bag[j].values()) - common)
        assert abs((values[i] == values[j]).mean() - true) < 0.12


# --- decontamination ----------------------------------------------------------------------

QUESTION = (
    "A train leaves Berlin at 40 km per hour and travels 120 km to reach the town of Hamburg "
    "before Anna Smith takes 3 apples from the table."
)


def found(spark, texts, items):
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    rows = decontaminate.contaminated(frame(spark, texts), benchmark).collect()
    return sorted((r.doc_id, r.item_id, r.kind) for r in rows)


def test_copies_and_templates(spark):
    again = QUESTION.replace("Berlin", "Paris").replace("40", "55").replace("120", "1,210.5").replace("Anna Smith", "Bob")
    texts = [None, "", "short", f"Words before. {QUESTION} After.", QUESTION.upper(), f"Well: {again}", "clean text " * 9000]
    items = [QUESTION, None, "", "an item of six short words"]
    expected = [(3, 0, "copy"), (4, 0, "copy"), (5, 0, "template")]
    assert found(spark, texts, items) == expected
    assert found(spark, [*texts, "Find an item of six short words here"], items) == [*expected, (7, 3, "copy")]
    assert found(spark, texts, []) == [] and found(spark, [], items) == []


def test_slots_must_agree(spark):
    item = "If Tom has 3 apples and gives 3 pears to Tom then how many of the 3 fruits does Tom keep"
    good = item.replace("3", "8").replace("Tom", "Eva")
    bad = "If Eva has 3 apples and gives 5 pears to Max then how many of the 9 fruits does Joe keep"
    assert found(spark, [good, bad], [item]) == [(0, 0, "template")]


def test_names_at_the_start_of_sentences():
    items = [
        "Ann has 12 marbles. Bob has 7 marbles. Cid has 5 marbles. How many in all?",
        "Tom, Eva (Max) and \"Kim\" pick 9 apples. Tom eats 2 of the apples. Is it Eva or Max who has more?",
    ]
    texts = [
        "Dan has 3 marbles. Eve has 19 marbles. Fay has 8 marbles. How many in all?",
        "Joe, Lea (Ian) and \"Pia\" pick 7 apples. Joe eats 4 of the apples. Is it Lea or Ian who has more?",
        "Sum it up: Dan has 3 marbles. Eve has 19 marbles. Fay has 8 marbles. How many in all?",
        "Dan sold 3 marbles. Eve lost 19 pears. Fay found 8 coins. How many in all?",
    ]
    held = decontaminate.Benchmark([0, 1], items)
    assert sorted((d, i, kind) for d, i, *_, kind in decontaminate.matches(held, texts)) == [
        (0, 0, "template"),
        (1, 1, "template"),
        (2, 0, "template"),
    ]


def test_items_dense_in_slots():
    items = [
        "Add 3 kg of Rice 4 kg of Beans 5 kg of Corn 6 kg of Oats",
        "What is 5 + 7?",
        "Now 7 km 5 kg 3 cm 4 mm by 5 kg 3 cm by 4 mm 9 km so that every one of the parts is equal",
        "1 2 3 4 5 6",
    ]
    texts = [
        "Please add 7 kg of Salt 9 kg of Flour 2 kg of Sugar 8 kg of Peas now",
        "add 7 kg of Salt 9 kg of Flour 2 kg of Sugar",
        "Tell me: what is 1,200 + 9?",
        "what is 3 to you",
        "numbers 9 8 7 6 5 4",
        "so that every one of the parts is equal",
    ]
    held = decontaminate.Benchmark([0, 1, 2, 3], items)
    got = sorted((d, i, kind) for d, i, *_, kind in decontaminate.matches(held, texts))
    assert [r for r in got if r[1] < 2] == [(0, 0, "template"), (2, 1, "template")]
    assert (5, 2, "copy") not in got and not [r for r in got if r[1] == 3]
    # only windows in the index count
    assert held.size["template"][2] < np.diff(held.streams["template"].first)[2] - decontaminate.WIDTH + 1


@pytest.mark.parametrize("n", [200, 400])
def test_a_long_run_of_a_long_item(n):
    words = [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(n)]
    words[60:80] = "so Tom takes 5 of the pears and then Eva takes 7 of the plums that he left in there".split()
    passage = " ".join(words[45:90])
    other = passage.replace("Tom", "Max").replace("Eva", "Lea").replace("5", "6").replace("7", "9")
    scattered = " and ".join(" ".join(words[i : i + 12]) for i in range(0, 48, 12))
    texts = [f"before it {passage} after it", f"before it {other} after it", f"before it {scattered} after it"]
    held = decontaminate.Benchmark([0], [" ".join(words)])
    got = [(d, i, kind) for d, i, *_, kind in decontaminate.matches(held, texts)]
    assert got == [(0, 0, "copy"), (1, 0, "template")]


def test_slices_find_the_same(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    whole = decontaminate.contaminated(docs, items)
    sliced = decontaminate.contaminated(docs, items, slice_chars=2000)
    assert sorted(whole.collect()) == sorted(sliced.collect())
    dirty = {r.doc_id for r in whole.collect()}
    kept = {r.doc_id for r in decontaminate.clean(docs, items, slice_chars=2000).collect()}
    assert kept == {r.doc_id for r in docs.collect()} - dirty


def test_every_planted_passage_is_found(spark):
    sf = "/root/testdata/sf0.01"
    items = [(r.item_id, re.findall(r"[^\W_]+", r.text.lower())) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    expected = set()
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        said = f" {' '.join(re.findall(r'[^\W_]+', r.text.lower()))} "
        expected |= {(r.doc_id, i) for i, words in items if f" {' '.join(words)} " in said}
    got = {(r.doc_id, r.item_id) for r in decontaminate.op9_decontamination(spark, sf).collect()}
    assert expected and expected <= got


# --- personal data ------------------------------------------------------------------------

PLAIN = {  # the patterns of the base kinds as they are specified
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(int(x) for x in reversed(digits)):
        total += (d * 2 - 9 if d > 4 else d * 2) if i % 2 else d
    return total % 10 == 0


def right(kind, value):
    digits = re.sub("[^0-9]", "", value)
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain_spans(text):
    spans = [
        (m.start(), k, m.end(), kind)
        for k, (kind, pattern) in enumerate(PLAIN.items())
        for m in re.finditer(pattern, text or "")
        if right(kind, m.group())
    ]
    return [f"{kind}:{a}:{b}" for a, _, b, kind in sorted(spans)]


def test_base_spans(spark, tmp_path):
    rng = random.Random(2)
    texts = [
        None,
        "",
        "a@b.c_d@e.f g@h",
        "1.2.3.4.5.6.7.8 300.1.1.1 00001.2.3.255",
        "4111 1111 1111 1111 x 4111-1111-1111-1111 4111111111111112",
        "😀😀 +1 (555) 123-4567 é a@b.co",
        "x" * 20_000 + "@",
        "1" * 5000,
        "a." * 9000 + "@" + "a." * 9000,
        "+1" * 3000,
    ] + ["".join(rng.choice("a1 2.3-@+()4%é😀._09\n") for _ in range(300)) for _ in range(150)]
    frame(spark, texts + texts[:3]).write.parquet(f"{tmp_path}/documents.parquet")
    rows = personal_data.op2_personal_data(spark, str(tmp_path)).collect()
    assert len(rows) == len(texts) + 3
    for r in rows:
        own = plain_spans((texts + texts[:3])[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(own).encode()).hexdigest()
        count = Counter(s.split(":")[0] for s in own)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(count[k] for k in PLAIN)
        assert set(own) <= set(r.spans.split(","))


def test_checksums_and_context(spark):
    docs = frame(
        spark,
        [
            "to GB82 WEST 1234 5698 7654 32 or DE89370400440532013000, not DE88370400440532013000",
            "ssn 123-45-6789",
            "part 123-45-6789",
            "pay by card 4111111111111111",
            "a 4111111111111111",
        ],
    )
    got = {r.doc_id: [(s.kind, s.begin, s.until, s.score) for s in r.spans] for r in personal_data.find(docs).collect()}
    assert [(k, a, b) for k, a, b, _ in got[0] if k == "iban"] == [("iban", 3, 30), ("iban", 34, 56)]
    assert [k for k, *_ in got[1]] == ["ssn"] and got[2] == []
    assert got[3][0][3] > got[4][0][3]


def test_redaction(spark):
    docs = frame(spark, [None, "", "é a@b.co and +1 (555) 123-4567.", "nothing", "card 4111 1111 1111 1111!"])
    got = {r.doc_id: r.text for r in personal_data.redact(docs).collect()}
    assert got == {0: None, 1: "", 2: "é [EMAIL] and [PHONE].", 3: "nothing", 4: "card [CARD]!"}
    assert personal_data.redact(docs).columns == docs.columns
    assert personal_data.redact(docs.limit(0)).count() == 0
