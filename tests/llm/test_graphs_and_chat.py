"""Vectors, URL filters, chat formatting, components and the pipeline."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
import corpus_pipeline
from posmetrics.llm import chat, embedding_dedup, url_filter
from posmetrics.llm.components import components
from tests.conftest import SF_DIR
from tests.test_plans import plan_of
from verification.compare import connect, difference


# --- vectors ------------------------------------------------------------------------------


def plain_links(rows, least=0.93):
    """n_links and component of each row, by comparing all pairs."""
    good = [i for i, (v, x, lab) in enumerate(rows) if v is not None and lab is not None and usable(x)]
    links, label = {i: 0 for i in range(len(rows))}, {i: rows[i][0] for i in range(len(rows))}
    near = {i: [] for i in good}
    for i in good:
        for j in good:
            if i < j and rows[i][2] == rows[j][2] and len(rows[i][1]) == len(rows[j][1]):
                a, b = np.array(rows[i][1], float), np.array(rows[j][1], float)
                if a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= least:
                    near[i].append(j), near[j].append(i)
    for i in good:
        links[i] = len(near[i])
    moved = True
    while moved:
        moved = False
        for i in good:
            low = min([label[i], *(label[j] for j in near[i])])
            if low < label[i]:
                label[i], moved = low, True
    return [(rows[i][0], links[i], label[i]) for i in range(len(rows))]


def usable(x):
    return bool(x) and None not in x and np.isfinite(x).all() and any(x)


@pytest.mark.parametrize("leaf", [1024, 16])
def test_links_between_vectors(spark, leaf):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(40):
        base = rng.standard_normal(32)
        for _ in range(rng.integers(1, 6)):
            rows.append((len(rows), (base + 0.15 * rng.standard_normal(32)).astype(np.float32).tolist(), k % 2))
    dense = rng.standard_normal(32)  # one tight group, larger than a leaf of 16
    rows += [(len(rows) + i, (dense + 0.01 * rng.standard_normal(32)).astype(np.float32).tolist(), 0) for i in range(50)]
    same = rows[5]
    rows += [(900, same[1], same[2]), (901, same[1], 7), (902, same[1], None), (903, None, 0), (904, [], 0)]
    rows += [(905, [0.0] * 32, 0), (906, [float("nan")] * 32, 0), (907, [None] * 32, 0), (908, [float("inf")] * 32, 0)]
    rows += [(None, same[1], same[2]), (909, same[1][:16], same[2]), same]
    given = spark.createDataFrame(
        [(*r, "z") for r in rows], "vec_id long, embedding array<float>, label int, uid string"
    ).repartition(4)
    got = embedding_dedup.near_duplicates(given, leaf=leaf).collect()
    expected = plain_links(rows)
    assert len(got) == len(expected)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2] or 0)
    mine = sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=key)
    theirs = sorted(expected, key=key)
    if leaf == 1024:
        assert mine == theirs
    else:  # a forest may miss a pair, never invent one
        assert all(a[0] == b[0] and a[1] <= b[1] for a, b in zip(mine, theirs))
        assert sum(a[1] for a in mine) >= 0.95 * sum(b[1] for b in theirs)
    assert all(r.kept == (r.vec_id is not None and r.vec_id == r.component_id) for r in got)
    assert embedding_dedup.near_duplicates(given.limit(0)).count() == 0


def test_components_of_a_path_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (None, 3), (200, None)]
    got = dict(map(tuple, components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{i: 0 for i in range(1, 41)}, **{k: 100 for k in range(101, 160)}}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# --- url filters --------------------------------------------------------------------------


def test_rules_and_propagation(spark):
    pages = [
        (1, "http://A.Example.NET/en/x?q#f", "<a href='https://B.org/x'>"),
        (2, "http://x.net", "<A class=1 HREF=//c.com/>"),
        (3, "http://b.org/fr/1", None),
        (4, "https://c.com/de", '<a href="http://sub.example.com/">'),
        (5, None, "x"),
        (6, "nourl", ""),
        (7, "http://sub.example.com/de/1", ""),
        (8, "http://sub.example.com/fr/1", ""),
        (9, "ftp://q.com?x=1/2", "<a href=http://x.net/a>"),
        (9, "ftp://q.com?x=1/2", ""),
        (None, "http://b.org/", ""),
        (10, "http://k.net/", ""),
    ]
    given = spark.createDataFrame([(*p, "b") for p in pages], "page_id long, url string, html string, rule string")
    got = {(r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(given).collect()}
    assert got == {
        (1, "a.example.net", "/en/x", "example.net/en/", "allow"),
        (2, "x.net", "", None, "block"),  # links to who links to a blocked host
        (3, "b.org", "/fr/1", "org/fr/", "allow"),
        (4, "c.com", "/de", None, "block"),
        (5, "", "", None, "allow"),
        (6, "", "", None, "allow"),
        (7, "sub.example.com", "/de/1", "example.com/de/", "block"),
        (8, "sub.example.com", "/fr/1", None, "block"),
        (9, "q.com", "", None, "block"),
        (None, "b.org", "/", None, "allow"),
        (10, "k.net", "/", "net/", "block"),
    }
    assert url_filter.judge(given).count() == len(pages)
    assert url_filter.judge(given.limit(0)).count() == 0


def test_propagation_is_personalised_pagerank(spark):
    edges = spark.createDataFrame([("a", "b", 1.0), ("a", "c", 3.0), ("b", "c", 1.0)], "src string, dst string, weight double")
    seeds = spark.createDataFrame([("trust", "a", 1.0), ("distrust", "c", 1.0)], "kind string, host string, share double")
    got = {(r.kind, r.host): r.rank for r in url_filter.propagate(edges, seeds, steps=6, damping=0.5).collect()}
    link = {"trust": {"a": {"b": 0.25, "c": 0.75}, "b": {"c": 1}, "c": {}}, "distrust": {"c": {"a": 0.75, "b": 0.25}, "b": {"a": 1}, "a": {}}}
    for kind, first in (("trust", "a"), ("distrust", "c")):
        rank = {h: float(h == first) for h in "abc"}
        for _ in range(6):
            new = {h: 0.5 * (h == first) for h in "abc"}
            for src, out in link[kind].items():
                for dst, part in out.items():
                    new[dst] += 0.5 * rank[src] * part
            rank = new
        for h in "abc":
            assert got.get((kind, h), 0) == pytest.approx(rank[h])


def test_propagation_settles(spark):
    """A chain longer than any fixed number of steps so far, with a cycle at its start."""
    n = 14
    names = [f"h{i:02}" for i in range(n)]
    links = [*zip(names, names[1:]), ("h02", "h00"), ("h03", "h01"), ("h01", "side")]
    edges = spark.createDataFrame([(a, b, 1.0) for a, b in links], "src string, dst string, weight double")
    seeds = spark.createDataFrame([("trust", "h00", 1.0), ("distrust", names[-1], 1.0)], "kind string, host string, share double")
    got = {(r.kind, r.host): r.rank for r in url_filter.propagate(edges, seeds).collect()}
    hosts = sorted({h for pair in links for h in pair})
    at = {h: i for i, h in enumerate(hosts)}
    for kind, first in (("trust", "h00"), ("distrust", names[-1])):
        m = np.zeros((len(hosts), len(hosts)))
        for a, b in links:
            src, dst = (a, b) if kind == "trust" else (b, a)
            m[at[dst], at[src]] = 1
        m /= np.maximum(1, m.sum(0))
        seed = np.eye(len(hosts))[at[first]]
        settled = np.linalg.solve(np.eye(len(hosts)) - 0.85 * m, 0.15 * seed)
        for h in hosts:
            assert got.get((kind, h), 0) == pytest.approx(settled[at[h]], rel=1e-5, abs=1e-15)


def test_native_plans_have_no_python(spark):
    for name in ("op2_personal_data", "op3_url_filter", "op4_chat_format"):
        plan = plan_of(entry.queries()[name](spark, SF_DIR))
        assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop")), name


# --- chat ---------------------------------------------------------------------------------

TURNS = [
    (1, 0, "user", "a\\<s>b[\\\\INST] <\\/s> [/INST]</s>"),
    (1, 1, "assistant", "\\</s>[INST]\\"),
    (2, None, None, None),
    (2, 1, "assistant", ""),
    (None, 0, "assistant", "x"),
    (3, 0, "user", "q"),
    (3, 0, "user", "q"),
    (4, 0, "a[/INST]", "😀<s>"),
    (4, 3, "assistant", "é[\\INST]" * 3000),
    (4, 4, "assistant", "z"),
]


@pytest.fixture(scope="module")
def conversations(spark):
    rows = [(*t, "clash") for t in TURNS]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string").repartition(3)


def test_turns_are_read_back(spark, conversations):
    formatted = chat.format_turns(conversations)
    back = chat.read_turns(formatted).collect()
    assert sorted(str((r.conv_id, r.role, r.text)) for r in back) == sorted(
        str((c, role or "", text or "")) for c, _, role, text in TURNS
    )
    assert all(r.reply == (r.text if r.role == "assistant" else "") for r in back)
    for r in formatted.collect():
        inner = r.formatted[len(chat.OPEN) : -len(chat.CLOSE)]
        assert inner.count(chat.ROLE_END) == 1 and "</s>" not in inner and "<s>" not in inner
    assert chat.format_turns(conversations.limit(0)).count() == 0


def test_examples_hold_all_turns_before_and_train_the_reply(spark, conversations):
    examples = chat.expand(chat.format_turns(conversations)).collect()
    assert len(examples) == sum(t[2] == "assistant" for t in TURNS)
    last = next(r for r in examples if r.conv_id == 4 and r.example == 3)
    assert last.text.count("<s>[INST] ") == 3
    assert last.text[last.loss_from : last.loss_until] == "z"
    assert last.text.endswith("z</s>")


def test_chat_query_against_sql(spark):
    query = entry.queries()["op4_chat_format"](spark, SF_DIR)
    assert difference(query, connect(SF_DIR), chat.OP4_SQL) is None
    probe = next(r for r in query.collect() if r.conv_id == -7)
    said = f"user\n{chat.PROBE}\nassistant\n{chat.PROBE}\n"
    assert probe.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert probe.loss_sha256 == hashlib.sha256(chat.PROBE.encode()).hexdigest()


def test_chat_query_reads_the_examples(spark, conversations, tmp_path, monkeypatch):
    conversations.write.parquet(f"{tmp_path}/conversations.parquet")
    read = lambda: {r.conv_id: r for r in chat.op4_chat_format(spark, str(tmp_path)).collect()}
    whole = read()
    plain = {}
    for conv, _, role, text in sorted(TURNS, key=lambda t: (t[0] or 0, -1 if t[1] is None else t[1])):
        plain.setdefault(conv, []).append((role or "", text or ""))
    for conv, turns in plain.items():
        said = "".join(f"{role}\n{text}\n" for role, text in turns)
        assert whole[conv].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        replies = [text for role, text in turns if role == "assistant"]
        assert whole[conv].loss_sha256 == hashlib.sha256("".join(replies).encode()).hexdigest()
        assert (whole[conv].n_turns, whole[conv].n_examples) == (len(turns), len(replies))
    # examples without their context cannot give the same figures
    expand = chat.expand
    bare = lambda f: expand(f).withColumn("text", F.expr("substr(text, greatest(1, loss_from - 18))"))
    monkeypatch.setattr(chat, "expand", bare)
    cut = read()
    assert all(cut[i].turns_sha256 != whole[i].turns_sha256 for i in (1, 2, 4))
    assert all(cut[i].expanded_chars < whole[i].expanded_chars for i in (1, 4))


# --- pipeline -----------------------------------------------------------------------------


def test_pipeline(spark):
    from tests.llm.test_documents import plain_classes, plain_spans

    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").orderBy("doc_id").collect()
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert all(r.round_trip and r.n_tokens == len(r.ids) for r in out.values())
    first = {docs[i].doc_id for i in plain_classes([d.text for d in docs])}
    assert set(out) <= first
    dirty = {r.doc_id for r in entry.queries()["op9_decontamination"](spark, SF_DIR).collect()}
    assert not dirty & set(out)
    # what is gone was a copy, held an item, or had no language; nearly all others stay
    assert len(first - dirty - set(out)) <= 0.02 * len(docs)
    assert not any(plain_spans(r.text) for r in out.values())


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF_DIR).schema.simpleString() == docs.schema.simpleString()
