"""Each corpus operator against a brute-force version, and on odd inputs."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tests.llm.conftest import ODD
from veleta.llm import bpe, exact_dedup, jaccard_join, packing, pii, quality_classifier, quality_rules, recurrent_lm, shingles, url_filters, warc
from veleta.llm.cache import Memo
from veleta.llm.components import components
from veleta.llm.queries import ORACLES, QUERIES, vocabulary_path
from veleta.llm.text import PART_BYTES, PART_ROWS, byte_words, parts, word_codes

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def rows_of(df):
    return [tuple(r) for r in df.collect()]


# quality rules


def brute_quality(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    failed = len(w) < 50 or 100 * len(covered) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered), failed


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_quality_rules(which, request):
    df = request.getfixturevalue(which)
    got = sorted(map(str, rows_of(quality_rules.score(df).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"))))
    assert got == sorted(str((r.doc_id, *brute_quality(r.text))) for r in df.collect())


def test_quality_rules_collision_path(spark):
    words = "a b c x a b c y z z z z".split()
    w = spark.createDataFrame([(words,)], "w array<string>")
    exact = w.select(quality_rules._repeated_by_text(F.col("w")), quality_rules._repeated(F.col("w"))).first()
    assert exact[0] == exact[1] == brute_quality(" ".join(words))[4]


def test_quality_rules_keep_clean_documents(docs, spark, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    rows = quality_rules.score(docs).join(labels, "doc_id").filter("not base_failed")
    assert rows.filter("quality = 1 and not kept").count() == 0
    assert rows.filter("quality = 0 and kept").count() == 0


# names of our own and names of the input

CLASHES = "q_ r t id h n s_ l_ n_ o_ os_ ol_ r_ n_bytes n_rows owner text_sha256 row row_ u_ t_ url_ at_ rank_ key_ first_ active_ list_key action valid_from verdict deciding_key n_active".split()


@pytest.mark.parametrize("part", range(3))
def test_column_names_do_not_clash(spark, odd, part):
    names = CLASHES[part::3]
    base = odd.select("doc_id", "text")
    more = base.withColumns({c: F.concat(F.lit(f"{c}:"), F.col("doc_id")) for c in names})
    own = lambda rows: all(r[c] == (None if r.doc_id is None else f"{c}:{r.doc_id}") for r in rows for c in names)
    kept = exact_dedup.drop_copies(more).collect()
    assert kept[0].__fields__ == more.columns and own(kept) and len(kept) == exact_dedup.drop_copies(base).count()
    kept = quality_rules.filter_documents(more, rules=quality_rules.RULES[:1]).collect()
    assert kept[0].__fields__ == more.columns and own(kept)
    redacted = pii.redact(more).collect()
    assert redacted[0].__fields__ == more.columns and own(redacted)
    pages = more.select(F.lit("http://a.b/c").alias("url"), F.lit("2024-01-01").cast("date").alias("fetched_at"), "doc_id", *names)
    entries = spark.createDataFrame([("a.b", "2023-01-01", "block")], "list_key string, listed_at string, action string").withColumn("listed_at", F.col("listed_at").cast("date"))
    judged = url_filters.judge(pages, entries)
    given = [c for c in pages.columns if c not in url_filters._RESULTS]
    assert judged.columns == [*given, *url_filters._RESULTS]  # a result takes the place of a column of its name
    assert all(r.verdict == "block" and all(r[c] == (None if r.doc_id is None else f"{c}:{r.doc_id}") for c in given[3:]) for r in judged.collect())


def plain_cell(x):
    if pd.isna(x):
        return "null"
    return f"{float(x):.6f}" if isinstance(x, (int, float, np.number)) and not isinstance(x, (bool, np.bool_)) else str(x).removesuffix(" 00:00:00")


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_queries_agree_with_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "labels"):
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    got, want = QUERIES[name](spark, sf_dir).toPandas(), con.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and len(got) == len(want)
    key = "page_id" if "page_id" in got else "doc_id"
    got, want = (x.sort_values(key).reset_index(drop=True)[sorted(x.columns)] for x in (got, want))
    for c in got:
        a, b = got[c], want[c]
        if str(a.dtype) == "float64" and str(b.dtype) == "float64":
            assert np.allclose(a, b, atol=2e-6, equal_nan=True), c
        else:
            assert list(map(plain_cell, a)) == list(map(plain_cell, b)), c


def test_memo_is_bounded_in_entries_and_bytes():
    made = Counter()
    memo = Memo(lambda k: made.update([k]) or k * 2, most=10, longest=5)
    for _ in range(2):
        for i in range(35):
            assert memo[str(i)] == str(i) * 2 and memo["long" * 9] == "long" * 18
    assert len(memo) <= 10 and len(memo.older) <= 10 and made["long" * 9] == 70
    memo.put("x", 1)
    assert memo["x"] == 1 and not memo.lacks("x") and memo.lacks("y") and not memo.lacks("longer")


# exact dedup


def brute_owners(rows):
    groups = defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append(i)
    out = []
    for t, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = min(known) if known else None
        out += [(i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()) for i in ids]
    return out


@pytest.mark.parametrize("which", ["docs", "odd"])
def test_exact_dedup(which, request):
    df = request.getfixturevalue(which)
    got = sorted(map(str, rows_of(exact_dedup.assign(df))))
    assert got == sorted(map(str, brute_owners([(r.doc_id, r.text) for r in df.collect()])))


def test_drop_copies_keeps_columns(odd, empty):
    kept = exact_dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    assert {r.doc_id for r in kept.collect()} == {1, 3, 4, 6, 7, 8, 9, 10, 11}
    assert exact_dedup.drop_copies(empty).count() == 0


@pytest.mark.parametrize("fan_in, hot", [(2, 1 << 17), (3, 0)])
def test_hot_texts_are_merged_in_a_tree(spark, docs, monkeypatch, fan_in, hot):
    """A text in every one of 11 partitions goes through several steps; so many hot texts as to be joined by a shuffle, too."""
    monkeypatch.setattr(exact_dedup, "FAN_IN", fan_in)
    monkeypatch.setattr(exact_dedup, "BROADCAST_OWNERS", hot)
    same = spark.range(100).select((1000 - F.col("id")).alias("doc_id"), F.when(F.col("id") % 3 > 0, "a  hot\ntext").otherwise("x").alias("text"))
    rows = docs.select("doc_id", "text").limit(40).unionByName(same).repartition(11)
    rows = exact_dedup.keep(spark, rows, "rows").repartition(11, "doc_id")
    got = sorted(map(str, rows_of(exact_dedup.assign(rows))))
    assert got == sorted(map(str, brute_owners([(r.doc_id, r.text) for r in rows.collect()])))
    owners = {r.n_rows: r.owner for r in exact_dedup.owners(rows).filter("n_rows > 30").collect()}
    assert owners == {66: 902, 34: 901}


def test_trie_owners_and_spill():
    rng = random.Random(3)
    keys = ["".join(rng.choice("ab") for _ in range(rng.randint(1, 12))).encode() for _ in range(2000)]
    trie, want = exact_dedup.OwnerTrie(), {}
    for i, k in enumerate(keys):
        trie.insert(k, i)
        want.setdefault(k, []).append(i)
    first = list(trie.spill())  # the largest subtree
    assert len({k[0] for k, _, _ in first}) == 1
    got = {k: (o, n) for k, o, n in [*first, *trie.spill_all()]}
    assert got == {k: (min(v), len(v)) for k, v in want.items()} and trie.size == 0


def test_trie_over_its_memory(docs, monkeypatch):
    monkeypatch.setattr(exact_dedup, "TRIE_BYTES", 10_000)
    import pyarrow as pa

    rows = [(i % 5, 3, b"abc" if i % 2 else b"%03d" % (i % 7), i) for i in range(500)]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), [pa.int64(), pa.int32(), pa.binary(), pa.int64()])], names=list("hnbo"))
    found = Counter()
    for out in exact_dedup.combine([batch] * 3):
        for b, n in zip(out.column(2).to_pylist(), out.column(4).to_pylist()):
            found[b] += n
    assert sum(found.values()) == 1500


# n-gram Jaccard join


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute_components(rows):
    sets = {i: shingle_set(t) for i, t in rows}
    ids, parent = sorted(sets), {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, i in enumerate(ids):
        for j in ids[:a]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                x, y = root(i), root(j)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), root(i)) for i in ids}


def near_copies(n, seed=1):
    """Copies of one text with a few words changed, many of them about as far apart as the threshold."""
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 400)}" for _ in range(150)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randint(0, 5)):
            w[rng.randrange(len(w))] = f"v{rng.randint(0, 9999)}"
        out.append((i, " ".join(w)))
    passage = " ".join(f"p{k}" for k in range(60))
    out += [(n + i, " ".join(f"u{rng.randint(0, 5000)}" for _ in range(60)) + " " + passage) for i in range(40)]
    return out


@pytest.mark.parametrize("long_above", [4, 16])
def test_jaccard_join_hot_group(spark, monkeypatch, long_above):
    monkeypatch.setattr(jaccard_join, "LONG_ABOVE", long_above)
    monkeypatch.setattr(jaccard_join, "PIVOTS", 3)
    monkeypatch.setattr(jaccard_join, "HOT_ABOVE", 10)
    rows = near_copies(80)
    got = {r[0]: tuple(r[1:]) for r in jaccard_join.link_components(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows)


def test_jaccard_join_documents(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = {r[0]: tuple(r[1:]) for r in jaccard_join.link_components(spark, docs).collect()}
    assert got == brute_components(rows)


def test_jaccard_join_odd(spark, odd, empty):
    got = rows_of(jaccard_join.link_components(spark, odd))
    assert len(got) == len(ODD)
    by = {r[0]: r[1:] for r in got}
    assert by[1] == (0, 1) and by[2] == (0, 2) and by[3] == (0, 3)
    assert by[4] == (1, 4) and by[5] == (1, 4) and by[10] == (1, 10)
    assert jaccard_join.link_components(spark, empty).count() == 0


def test_jaccard_join_compares_words(spark):
    """Words whose letters make a polynomial hash meet, whatever its multiplier: a Thue-Morse word and its complement."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    b = a.translate(str.maketrans("ab", "ba"))
    rows = [(1, f"{a} p q r s"), (2, f"{b} p q r s"), (3, f"{a}  P q r s")]
    got = {r[0]: r[2] for r in jaccard_join.link_components(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 1, 2: 2, 3: 1}


def test_jaccard_join_repeated_identifiers(spark):
    """One identifier on two texts links what either of them links with; null identifiers link and name nothing."""
    rng = random.Random(7)
    one, two, three = (" ".join(f"w{rng.randint(0, 999)}" for _ in range(60)) for _ in range(3))
    rows = [(5, one), (5, two), (5, two), (7, one + " x"), (9, two + " y"), (None, three), (None, three), (None, three + " z"), (12, three), (3, "alone"), (None, "nobody")]
    got = jaccard_join.link_components(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3))
    assert sorted(got.select("doc_id", "component_id").collect(), key=str) == sorted(
        [(5, 5)] * 3 + [(7, 5), (9, 5)] + [(None, 12)] * 3 + [(12, 12), (3, 3), (None, None)], key=str
    )


def test_jaccard_join_long_postings_meet_in_blocks(spark, monkeypatch):
    """Groups around a shared passage, of many sizes, that pivots do not settle."""
    for name, value in (("LONG_ABOVE", 4), ("PIVOTS", 1), ("HOT_ABOVE", 10**6), ("BLOCK", 8)):
        monkeypatch.setattr(jaccard_join, name, value)
    rng = random.Random(11)
    passage = " ".join(f"p{k}" for k in range(40))
    rows = []
    for i in range(70):
        own = [f"u{i // 2}_{k}" for k in range(3 + rng.randint(0, 60))] if i % 2 == 0 else own[: len(own) - i % 3]
        rows.append((i, passage + " " + " ".join(own)))
    got = {r[0]: tuple(r[1:]) for r in jaccard_join.link_components(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute_components(rows) and len({c for _, c in got.values()}) > 5


def test_components(spark):
    edges = [(1, 2), (2, 3), (7, 3), (10, 11), (11, 10), (5, 5), (20, 19), (19, 18), (18, 17), (17, 16)]
    got = dict(rows_of(components(spark, spark.createDataFrame(edges, "u long, v long"))))
    assert got == {1: 1, 2: 1, 3: 1, 7: 1, 10: 10, 11: 10, **{i: 16 for i in range(16, 21)}}


# personal data


def brute_spans(text):
    out = []
    for kind in pii.KINDS:
        for m in re.finditer(pii.PATTERNS[kind].pattern, text):
            d = re.sub("[^0-9]", "", m.group())
            ok = {
                "email": lambda: True,
                "ip": lambda: all(int(x) <= 255 for x in m.group().split(".")),
                "card": lambda: 16 <= len(d) <= 19 and pii.luhn(d),
                "phone": lambda: 8 <= len(d) <= 15,
            }[kind]()
            if ok:
                out.append((kind, *m.span()))
    return out


def test_base_spans(docs):
    texts = [r.text for r in docs.collect()] + [t for _, t in ODD if t]
    texts += ["a@b.c@d.e.f", "x@@y.z", "..@a.b", "+1 23456789", "1.2.3.4.5.6.7.8", "999.1.1.1", "a@b", "4111-1111 1111 1111 1", "@a.b x@y.z"]
    for t in texts:
        assert pii.base_spans(t) == brute_spans(t)


def test_field_labels_repeats_alike():
    text = "Call +1 (017) 555-7713 now. Later 1 (017) 555-7713 again; 12345678901 is a number."
    added = pii.added_spans(text, pii.base_spans(text))
    assert [(k, text[a:b]) for k, a, b in added] == [("phone", "1 (017) 555-7713")]
    assert pii.added_spans("12345678901 and 12345678901", []) == []


def test_detect_keeps_base_and_is_native_for_the_rest(docs, odd, empty):
    out = pii.report(pii.detect(odd, weights=pii.fit(odd)))
    assert out.count() == len(ODD)
    row = out.filter("doc_id = 8").first()
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 1)
    assert out.filter("doc_id = 1").first().spans == ""
    assert pii.report(pii.detect(empty)).count() == 0 and pii.fit(empty) == pii.WEIGHTS
    for r in pii.report(pii.detect(docs)).collect():
        assert len(r.base_sha256) == 64


def test_marginals_on_a_chain_are_exact():
    rng = np.random.default_rng(1)
    e, edges = rng.normal(size=(3, 2)), [(0, 1, "same"), (1, 2, "chain")]
    w = {"same": 1.3, "chain": 0.4}
    total = np.zeros((3, 2))
    for a in range(2):
        for b in range(2):
            for c in range(2):
                p = np.exp(e[0, a] + e[1, b] + e[2, c] + w["same"] * (a == b) + w["chain"] * (b == c))
                for i, x in enumerate((a, b, c)):
                    total[i, x] += p
    got = pii.marginals(e, [(i, j, w[k]) for i, j, k in edges], 60)
    assert np.allclose(got, total / total.sum(1, keepdims=True), atol=1e-3)


@pytest.mark.parametrize("seed", range(6))
def test_marginals_on_small_loops_pick_the_exact_label(seed):
    """Loops of tokens with four labels: the beliefs pick the exact most likely label, and are near the exact probabilities."""
    import itertools

    rng = np.random.default_rng(seed)
    n, labels = 5, 4
    e = rng.normal(size=(n, labels)) * 1.5
    edges = [(i, i + 1, 0.2) for i in range(n - 1)] + [(0, 2, 1.0), (2, 4, 1.0), (0, 4, 1.0)]
    total = np.zeros((n, labels))
    for x in itertools.product(range(labels), repeat=n):
        p = np.exp(sum(e[i, x[i]] for i in range(n)) + sum(w * (x[i] == x[j]) for i, j, w in edges))
        for i in range(n):
            total[i, x[i]] += p
    exact = total / total.sum(1, keepdims=True)
    got = pii.marginals(e, edges, 100)
    sure = np.sort(exact, 1)[:, -1] - np.sort(exact, 1)[:, -2] > 0.15
    assert (got.argmax(1) == exact.argmax(1))[sure].all() and np.abs(got - exact).max() < 0.12


def test_field_runs_without_base_spans_and_knows_secrets():
    secret = "04dbebab91ab85687d33eeaaf9ac699e1188f962"
    text = f'Set token = "{secret}" here. Again {secret} there. 4294967296 rows, order 123456789012.'
    assert pii.base_spans(text) == []
    assert [(k, text[a:b]) for k, a, b in pii.added_spans(text, [])] == [("secret", secret)] * 2
    assert pii.redact_text(text).count("[secret]") == 2
    assert pii.added_spans("x" * 50 + " 12345678901234567890123 " + "ab" * 30 + "1" * 9, []) == []
    found = pii.added_spans("ask jane.doe@mail.example.org or jane.doe@other now", pii.base_spans("ask jane.doe@mail.example.org or jane.doe@other now"))
    assert all(k == "email" for k, _, _ in found)


def test_numbers_in_a_list_are_tokens_of_their_own():
    def added(text):
        return [(k, text[a:b]) for k, a, b in pii.added_spans(text, pii.base_spans(text))]

    phone = "Call +1 415 555 2671 or fax +1 415 555 2671; then "
    assert added(phone + "14155552671 14155552672") == [("phone", "14155552671")]
    assert added(phone + "14155552671 2024-01-05") == [("phone", "14155552671")]
    assert added(phone + "2024-01-05 1 415 555 2671 77") == [("phone", "1 415 555 2671")]
    assert added(phone + "1 4155552671 or 3141592653589") == [("phone", "1 4155552671")]
    assert added(" ".join(str(10**10 + 7 * i) for i in range(50))) == []
    mail = "a.bcde@x.org or a.bcde@x.org, "
    assert added(mail + "(a.bcde@localhost).") == [("email", "a.bcde@localhost")]
    rows = ",".join(f"a.bcde@x{i}.org" for i in range(8))
    assert pii._tokens(rows, pii.base_spans(rows)) == [(a, b) for _, a, b in pii.base_spans(rows)] and len(pii.base_spans(rows)) == 8


@pytest.mark.parametrize("seed", range(40))
def test_added_spans_are_those_of_the_exact_field(seed):
    """Small documents: tokens do not overlap, and what is added is what exact enumeration labels with certainty."""
    import itertools

    rng = random.Random(seed)
    some = ["+1 415 555 2671", "14155552671", "1 415 555 2671", "4155552671", "2024-01-05", "77", "tel", "a.bcde@x.org", "a.bcde@localhost", "and", "4111 1111 1111 1111", "4111111111111111", "10.0.0.1", ","]
    text = " ".join(rng.choice(some) for _ in range(6))
    spans = pii.base_spans(text)
    tokens, w = pii._tokens(text, spans), pii.WEIGHTS
    assert all(x[1] <= y[0] for x, y in zip(tokens, tokens[1:]))
    labels = pii._labels(tokens, spans)
    e = pii._features(text, tokens) @ np.array([w.shape, w.cue, w.secret_shape, w.secret_cue])
    e[:, 0] += w.other
    for i, y in enumerate(labels):
        e[i, max(y, 0)] += pii.HELD * (y != 0)
    edges = pii._edges([pii._key(text[a:b]) for a, b in tokens])
    total = np.zeros_like(e)
    for x in itertools.product(*[range(6) if not y else [max(y, 0)] for y in labels]):
        p = np.exp(sum(e[i, v] - e[i].max() for i, v in enumerate(x)) + sum(getattr(w, k) * (x[i] == x[j]) for i, j, k in edges))
        for i, v in enumerate(x):
            total[i, v] += p
    p = total / total.sum(1, keepdims=True) if tokens else total
    sure = {i: p[i].max() for i, y in enumerate(labels) if not y and p[i].argmax()}
    got = set(pii.added_spans(text, spans))
    for i, v in sure.items():
        if abs(v - pii.CERTAIN) > 0.03:
            assert ((pii.LABELS[p[i].argmax() - 1], *tokens[i]) in got) == (v > pii.CERTAIN), text
    assert {(a, b) for _, a, b in got} <= {tokens[i] for i in sure}


def test_tokens_take_linear_time():
    import time

    began = time.time()
    pii.added_spans("a1" * 500_000 + " @" + "b" * 500_000 + " " + "7" * 300_000, [])
    assert time.time() - began < 20


def test_field_learning_finds_the_optimum(spark, docs):
    """No small change of the learned weights does better on the mean pseudo-likelihood with its prior."""
    w = pii.fit(docs)
    patterns = Counter()
    for r in docs.collect():
        patterns.update(pii.token_patterns(r.text or ""))
    prior = np.array([getattr(pii.WEIGHTS, f) for f in pii._FIELDS])

    def value(v):
        total, n = 0.0, 0
        for (p, y), times in patterns.items():
            x = pii.features_of(p)
            x = np.concatenate([np.eye(len(x))[:, :1], x], 1)
            s = x @ v
            total, n = total + times * (s[y] - np.log(np.exp(s).sum())), n + times
        return total / n - pii.PRIOR / 2 * ((v - prior) ** 2).sum()

    best = np.array([getattr(w, f) for f in pii._FIELDS])
    assert patterns and all(value(best) >= value(best + step * np.eye(len(best))[i]) for i in range(len(best)) for step in (-0.05, 0.05))


def test_redact(odd):
    by = {r.doc_id: r.text for r in pii.redact(odd).collect()}
    assert by[8].endswith("mail [email] and [phone], [ip], [card]") and by[1] is None


# tokenizers


def test_bpe_round_trip(docs, odd, empty):
    path = vocabulary_path("byte_bpe_50k.json")
    t = Tokenizer.from_file(path)
    t.no_truncation(), t.no_padding()
    for df in (docs, odd):
        text = Counter((r.doc_id, r.text or "") for r in df.collect())
        got = Counter()
        for r in bpe.round_trip(df, path).collect():
            ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
            want = [x for (i, x) in text if i == r.doc_id]
            match = [x for x in want if t.encode(x, add_special_tokens=False).ids == ids]
            assert match and r.decoded == t.decode(ids, skip_special_tokens=False)
            got[(r.doc_id, match[0])] += 1
        assert got == text
    assert bpe.round_trip(empty, path).count() == 0


def test_bpe_long_fragments_and_cuts():
    v = bpe.vocabulary(vocabulary_path("byte_bpe_50k.json"))
    rng = random.Random(5)
    for _ in range(30):
        body = bytes(rng.choice(b"abcdefgh \xc3\xa9tion") for _ in range(200))
        parts = [v.byte_id[b] for b in body]
        assert v._merge(list(parts)) == v._merge_long(list(parts))
        assert b"".join(v.cut(body)) == body
        joined = [i for f in v.cut(body) for i in v._merge([v.byte_id[b] for b in f])]
        assert joined == v._merge(list(parts))  # a cut never changes the result


def check_packing(df, spark):
    path = vocabulary_path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.no_truncation(), t.no_padding()
    want = Counter()
    total = 0
    for r in df.collect():
        ids = np.array([*t.encode(r.text or "", add_special_tokens=False).ids, 1], "<u4")
        total += len(ids)
        for piece, s in enumerate(range(0, len(ids), 4096)):
            want[(r.doc_id, piece, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes()))] += 1
    got = packing.pack(spark, df, path).toPandas()
    ids = [None if x != x else int(x) for x in got.doc_id]
    assert Counter(zip(ids, got.piece, got.start, got.length, got.ids_crc32)) == want
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    assert got.groupby("sequence_id").length.sum().max() <= 4096 if len(got) else True
    return got.sequence_id.nunique(), -(-total // 4096)


def test_jaccard_hashes_a_word_once_and_folds_sets_together(monkeypatch):
    """Hashes of sets are those of one set after the other, empty ones and broken UTF-8 included; a word of a batch is hashed once."""
    rng = np.random.default_rng(5)
    sets = [rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (0, 3, 1, 0, 40, 0)]
    for seed in (1, 4):
        want = [int(np.bitwise_xor.reduce(shingles.mix(s + np.uint64(seed)), initial=np.uint64(seed)).view(np.int64)) for s in sets]
        assert jaccard_join._folds(sets, seed).to_pylist() == want
        assert jaccard_join._folds(sets[:1], seed).to_pylist() == [seed] and jaccard_join._folds([], seed).to_pylist() == []
    texts = [b"a b A c a b a c", b"", b" \t", b"\xff\xc3 B a\x0b\x85 a b", b"a b"]
    asked, own = [], shingles.xxh3_64_intdigest
    monkeypatch.setattr(shingles, "xxh3_64_intdigest", lambda w: asked.append(w) or own(w))
    got = list(shingles.double_hash_sets(texts))
    assert sorted(asked) == sorted({w for t in texts for w in byte_words(t)})
    for t, (h, g) in zip(texts, got):
        assert len(h) == len(g) == len(shingles.word_shingles(t)) and (np.diff(h.astype(object)) > 0).all()
        (alone, beside), = shingles.double_hash_sets([t])
        assert h.tolist() == alone.tolist() and g.tolist() == beside.tolist()


def test_words_of_a_batch_are_looked_up_once():
    """Codes of distinct words give back the words of each text; a part is bounded in rows and bytes; a word's number is asked for once."""
    texts = ["", " ", "A b\ta\x0bB", None, "  \r\x0cé É \x1ca\x85b\xa0 ", "x" * 50, "a A a"]
    for own in (texts, texts[5:], [None], ["a"], []):
        words, codes, bounds = word_codes(pa.array(own, pa.string()))
        assert len(set(words)) == len(words)
        assert [[words[c] for c in codes[a:b]] for a, b in zip(bounds, bounds[1:])] == [byte_words((t or "").encode()) for t in own]
    sliced = pa.array(texts, pa.string()).slice(2, 3)
    words, codes, bounds = word_codes(sliced)
    assert [[words[c] for c in codes[a:b]] for a, b in zip(bounds, bounds[1:])] == [byte_words((t or "").encode()) for t in texts[2:5]]
    many = ["y" * n for n in (3, PART_BYTES + 1, 0, PART_BYTES, 1)] + [None] * (PART_ROWS + 5)
    batch = pa.RecordBatch.from_arrays([pa.array(many, pa.string())], ["text"])
    cut = list(parts(batch, 0))
    assert [t for c in cut for t in c.column(0).to_pylist()] == many
    assert [c.num_rows for c in cut] == [1, 1, 2, PART_ROWS, 6]
    asked = []
    batch = pa.RecordBatch.from_arrays([pa.array(["a b A", None, "b c"])], ["text"])
    held = list(recurrent_lm._chunks([batch], lambda w: asked.append(w) or ord(w)))
    assert [d.tolist() for d in held[0]] == [[97, 98, 97, 0], [0], [98, 99, 0]] and sorted(asked) == [b"a", b"b", b"c"]


def test_units_are_tokenized_once():
    """Chunks that differ in case and signs share their units, and all kinds of characters give the library's identifiers."""
    path = vocabulary_path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    around = ["a{}b", "A{}", "{}", "H{}\u0331 x", "1{}2"]
    texts = [" ".join(a.format(chr(c)) for a in around) for c in [*range(0x250), 0x300, 0x345, 0x3A3, 0x1E9E, 0x2028, 0x212A, 0x212B, 0xFB01, 0x1F600]]
    texts += ["", " \n ", "it's IT'S ('s \"'ll 'd'D 're9've", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>\n<|", "x" * 300 + " " + "=" * 300, "ΟΔΟΣ İi ß ẞ e\u0301E\u0301", "one\ttwo\x0bthree\x1cfour\x85five"]
    tokenizer = packing.WordTokenizer(path)
    for _ in range(2):
        for got, text in zip(tokenizer.encode(texts), texts):
            assert np.frombuffer(got, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    tokenizer = packing.WordTokenizer(path)
    calls = []
    tokenizer._ids = lambda text, ids=tokenizer._ids: calls.append(text) or ids(text)
    tokenizer.encode(["Hello, world! HELLO. hello? (World)", "hello's"])
    tokenizer.encode(["WORLD\nhello,"])
    assert len(calls) == 1 and len(set(calls[0].split(" "))) == len(calls[0].split(" ")) == 9, calls
    tokenizer.units.most = 2  # evicted in the middle of a call
    assert np.frombuffer(tokenizer.encode(["u v w x y z u v w"])[0], "<u4").tolist() == library.encode("u v w x y z u v w").ids


def test_packing(spark, docs, odd, empty):
    made, least = check_packing(docs, spark)
    assert made <= 1.03 * least + 1
    check_packing(odd, spark)
    assert packing.pack(spark, empty, vocabulary_path("word_bpe_49k.json")).count() == 0


def test_sum_of_squares_takes_the_best_gap():
    rng = np.random.default_rng(2)
    lengths = rng.integers(1, 21, 300)
    sequence, offset = packing.sum_of_squares(lengths, 20)
    gaps = {}
    for s, q, o in zip(lengths.tolist(), sequence.tolist(), offset.tolist()):
        counts = Counter(g for g in gaps.values() if 0 < g < 20)

        def after(gap):
            c = counts.copy()
            if gap < 20:
                c[gap] -= 1
            if gap > s:
                c[gap - s] += 1
            return sum(v * v for v in c.values())

        options = {g for g in counts if g >= s} | {20}
        assert after(20 - o) == min(map(after, options)) if s < 20 else o == 0
        gaps[q] = 20 - o - s


# WARC


def brute_records(rows, least=1000):
    top = {}
    for i, _, h in rows:
        if len((h or "").encode()) >= least and i is not None:
            top[h] = max(i, top.get(h, i))
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        other = top.get(h) if len(b) >= least else None
        revisit = other is not None and i != other
        out.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if revisit else "response", other if revisit else None))
    return out


def test_warc_round_trip(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    big, shared = "é<p>\r\n\r\n" * 30_000, "z" * 1000
    extra = [(9001, "u\r\nx", big), (9002, None, big), (9003, "a", None), (9003, "a", None), (None, "n", shared), (9004, "b", shared), (9005, "c", "z" * 999), (9006, "d", "z" * 999)]
    pages = pages.select("page_id", "url", "html").unionByName(spark.createDataFrame(extra, "page_id long, url string, html string"))
    got = warc.round_trip(spark, pages.withColumn("payload", F.lit(1))).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert Counter(rows_of(got)) == Counter(brute_records([tuple(r) for r in pages.collect()]))
    assert warc.round_trip(spark, pages.filter("false")).count() == 0


def test_warc_chunks_are_a_gzip_file_and_damage_shows():
    import gzip

    body, chunk = b"x" * 250_000, warc.CHUNK_BYTES
    digest, cuts = hashlib.sha1(body).hexdigest(), range(0, len(body), chunk)
    writer = warc.RecordWriter("2024-01-01T00:00:00Z")
    made = [writer.rows("k", 1, "http://a/", len(body), digest, False, None, None, no, i + chunk >= len(body), body[i : i + chunk]) for no, i in enumerate(cuts)]
    rows = [r for part in made for r in part]
    raw = gzip.decompress(b"".join(r[3] for r in rows))
    assert raw.startswith(b"WARC/1.1\r\n") and raw.endswith(b"x\r\n\r\n") and len(rows) == 5
    assert b"\r\nWARC-Date: 2024-01-01T00:00:00Z\r\n" in raw and b"\r\nWARC-Record-ID: <urn:uuid:k>\r\n" in raw
    with pytest.raises(ValueError, match="do not make"):
        list(warc.RecordWriter("d").rows("k", 1, None, 3, digest, False, None, None, 0, True, b"abc"))
    reader = warc.RecordReader()
    reader.feed(0, rows[0][2], rows[0][3])
    with pytest.raises(ValueError, match="missing"):
        reader.feed(2, rows[2][2], rows[2][3])
    reader = warc.RecordReader()
    reader.feed(0, rows[0][2], rows[0][3])
    with pytest.raises(ValueError, match="damaged"):
        reader.feed(1, rows[2][2][::-1], rows[1][3])


# URL filters


def test_url_filters(spark):
    entries = spark.createDataFrame(
        [("example.com", "2024-01-10", "block"), ("example.com", "2024-02-10", "allow"), ("example.com", "2024-02-10", "allow"), ("a.example.com", "2024-02-20", "block"), ("x.org/p", "2024-01-01", "block"), (None, "2024-01-01", "block"), ("x.org", None, "block")],
        "list_key string, listed_at string, action string",
    ).withColumn("listed_at", F.col("listed_at").cast("date"))
    captures = [
        (1, "http://a.example.com/q", "2024-01-09", "allow", None, 0),
        (2, "https://user@A.example.com:80/q", "2024-01-10", "block", "example.com", 1),
        (3, "http://example.com", "2024-02-10", "allow", "example.com", 1),
        (4, "http://a.example.com/", "2024-03-01", "block", "a.example.com", 2),
        (5, "http://x.org/p?x=1", "2024-03-01", "block", "x.org/p", 1),
        (5, "http://x.org/p?x=1", "2024-03-01", "block", "x.org/p", 1),
        (6, "http://x.org/pq", "2024-03-01", "allow", None, 0),
        (7, None, "2024-03-01", "allow", None, 0),
        (8, "http://x.org/p", None, "allow", None, 0),
        (9, "nonsense", "2024-03-01", "allow", None, 0),
    ]
    df = spark.createDataFrame([c[:3] for c in captures], "page_id long, url string, fetched_at string").withColumn("fetched_at", F.col("fetched_at").cast("date")).withColumn("action", F.lit("mine"))
    got = Counter((r.page_id, r.verdict, r.deciding_key, r.n_active) for r in url_filters.judge(df, entries).collect())
    assert got == Counter((c[0], *c[3:]) for c in captures)
    assert url_filters.judge(df.filter("false"), entries).count() == 0 and url_filters.judge(df, entries.filter("false")).filter("verdict = 'allow'").count() == 10


# quality classifier


def test_quality_classifier(spark, docs, odd, empty, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    train, held = labels.filter("doc_id % 3 > 0"), labels.filter("doc_id % 3 = 0")
    scored = quality_classifier.classify(docs, train).join(held, "doc_id")
    right = scored.filter("cast(kept as int) = quality").count()
    assert right >= 0.93 * held.count()
    out = quality_classifier.classify(odd, labels.filter("false"))
    assert out.count() == len(ODD) and out.filter("p_good is null").count() == 0
    assert quality_classifier.classify(empty, labels).count() == 0


def test_sparse_sites_shrink(spark):
    rows = [(i, "good words " * 30, "big" if i < 60 else f"s{i}", "en") for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    labels = spark.createDataFrame([(i, 0 if i < 60 and i % 2 else 1) for i in range(62)], "doc_id long, quality int")
    by = {r.doc_id: r for r in quality_classifier.classify(docs, labels).collect()}
    assert abs(by[63].p_host - by[62].p_host) < 1e-9  # no labels: the prior
    assert 0.4 < by[0].p_host < 0.6


# language model


def test_language_model(spark, docs, odd, empty):
    got = recurrent_lm.score(spark, docs).toPandas()
    texts = {r.doc_id: [w.translate(LOWER) for w in WORD.findall(r.text)] + ["\n"] for r in docs.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 5 == 1 for i in texts}
    counts = Counter(w for i, t in texts.items() if not held[i] for w in t)
    n, v = sum(counts.values()), len(counts)
    for r in got.itertuples():
        t = texts[r.doc_id]
        base = sum(np.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[r.doc_id], len(t), sum(counts[w] > 0 for w in t), n)
        assert abs(r.base_score - base) < 1e-6 * abs(base) and r.score < 0
    new = got[got.held_out]
    assert len(new) and new.score.sum() > new.base_score.sum()  # documents that were not trained on
    out = recurrent_lm.score(spark, odd)
    assert out.count() == len(ODD) and out.filter("score is null or base_score is null").count() == 0
    assert out.filter("doc_id = 1").first().n_tokens == 1
    assert recurrent_lm.score(spark, empty).count() == 0


def test_language_model_score_adds_up_over_words(spark, docs, monkeypatch):
    """The score is the model's own log probability, slot and word in the slot, by a loop over one document at a time."""
    made = {}
    fit = recurrent_lm.fit
    monkeypatch.setattr(recurrent_lm, "fit", lambda s, d, v: made.update(v=v) or made.setdefault("m", fit(s, d, v)))
    monkeypatch.setattr(recurrent_lm, "KNOWN_WORDS", 6000)  # so that some words are looked up by a join
    got = {r.doc_id: r.score for r in recurrent_lm.score(spark, docs).collect()}
    m, v = made["m"], made["v"]
    counts = Counter(w for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 5 != 1 for w in [*recurrent_lm.tokens(r.text), b"\n"])
    number = {w.encode(): i for i, w in enumerate(v.words[: m.k])}
    for r in docs.limit(25).collect():
        words = [*recurrent_lm.tokens(r.text), b"\n"]
        ids = [number.get(w, m.k + recurrent_lm.slot_of(w, len(v.slots))) for w in words]
        inside = sum(np.log10((counts[w] + 0.5) / v.slots[i - m.k]) for w, i in zip(words, ids) if i >= m.k)
        want = plain_log_likelihood(m, ids) / np.log(10) + inside
        assert abs(got[r.doc_id] - want) < 1e-4 * abs(want) + 1e-3


def plain_log_likelihood(m, ids):
    """One document, one word after the other, every probability normalised over all its alternatives."""
    p, h, state, total, before = {n: x.astype(float) for n, x in m.parts.items()}, recurrent_lm.UNITS, np.zeros(recurrent_lm.UNITS), 0.0, 0
    soft = lambda x: x - x.max() - np.log(np.exp(x - x.max()).sum())
    for i in ids:
        given = p["x"][min(before, m.k)] + p["b"]
        if before >= m.k and m.base > 1:
            given = given + p["xr"][(before - m.k) // len(p["xc"])] + p["xc"][(before - m.k) % len(p["xc"])]
        a = given + state @ p["u"]
        z, g = np.clip(a[:h], 0, 1), a[h:] / (1 + np.abs(a[h:]))
        state = z * g + (1 - z) * state
        c = i // recurrent_lm.CLASS_WORDS if i < m.k else len(p["ww"])
        total += soft(state @ p["cw"] + p["cb"])[c]
        if i < m.k:
            total += soft(state @ p["ww"][c] + p["wb"][c])[i % recurrent_lm.CLASS_WORDS]
        elif m.base > 1:
            digits = [(i - m.k) // m.base ** (recurrent_lm.DIGITS - 1 - j) for j in range(recurrent_lm.DIGITS)]
            for j, d in enumerate(digits):
                logits = (state @ p["tw"])[j * m.base : (j + 1) * m.base] + m.levels[j][d // m.base]
                total += soft(logits)[d % m.base]
        before = i
    return total


@pytest.mark.parametrize("window", [7, 64])
def test_language_model_carries_its_state_through_documents(monkeypatch, window):
    rng = np.random.default_rng(4)
    m = recurrent_lm.Model.new(rng.integers(1, 50, 90).astype(float), 300.0, slots=rng.uniform(0.5, 9, 81))
    m.flat += rng.normal(size=m.flat.size).astype(np.float32) * 0.3
    docs = [np.append(rng.integers(1, 171, n), 0).astype(np.int32) for n in (0, 1, 300, 5, 90, 33)]
    monkeypatch.setattr(recurrent_lm, "SCORE_WINDOW", window)
    monkeypatch.setattr(recurrent_lm, "LANES", 2)
    assert np.allclose(recurrent_lm.score_docs(m, docs), [plain_log_likelihood(m, d.tolist()) for d in docs], rtol=1e-4)


def test_language_model_segments_hold_every_token():
    docs = [np.arange(1, n + 1, dtype=np.int32) for n in (1, 4, 5, 13)]
    parts, firsts = recurrent_lm.segments(docs, 4)
    assert np.concatenate(parts).tolist() == np.concatenate(docs).tolist() and max(map(len, parts)) == 4
    assert firsts == [0, 0, 0, 4, 0, 4, 8, 12]
    laid = recurrent_lm.Lanes(parts, 3, firsts)
    seen = [[int(s), int(t)] for s_, t_, _, live, _ in laid.windows(3) for s, t in zip(s_[live], t_[live])]
    assert sorted(seen) == sorted([int(d[i - 1]) if i else 0, int(d[i])] for d in docs for i in range(len(d)))


def test_language_model_is_a_distribution_and_learns():
    rng = np.random.default_rng(0)
    model = recurrent_lm.Model.new(np.array([50.0, 400, 300, 200]), 50.0)
    states = rng.normal(size=(3, recurrent_lm.UNITS)).astype(np.float32)
    for s in states:
        p = np.exp(model.log_probs(np.repeat(s[None], 5, 0), np.arange(5)))
        assert abs(p.sum() - 1) < 1e-4
    docs = [np.array([1, 2, 3] * 20 + [0], np.int32) for _ in range(64)]
    before = recurrent_lm.score_docs(model, docs).sum()
    model, n = recurrent_lm.train(model, [docs] * 30, lanes=16)
    assert n == 30 * 64 * 61 and recurrent_lm.score_docs(model, docs).sum() > 0.5 * before


def check_gradient(m, docs, places):
    m.parts = {n: v.astype(np.float64) for n, v in m.parts.items()}
    seen, target, fresh, live, _ = next(recurrent_lm.Lanes(docs, 3).windows(1 << 20))
    start = np.zeros((seen.shape[1], recurrent_lm.UNITS), np.float32)

    def loss():
        after = m.steps(start, seen, fresh)[1]
        lp = m.log_probs(after.reshape(-1, recurrent_lm.UNITS).astype(np.float64), target.ravel())
        return -(lp * live.ravel()).sum() / live.sum()

    grads, _ = m.gradient(start, seen, target, fresh, live)
    for n, at in places(seen):
        old, e = m.parts[n][at], 1e-2
        m.parts[n][at] = old + e
        high = loss()
        m.parts[n][at] = old - e
        low = loss()
        m.parts[n][at] = old
        assert abs(grads[n][at] / live.sum() - (high - low) / (2 * e)) < 2e-4


def test_language_model_gradient():
    rng = np.random.default_rng(0)
    m = recurrent_lm.Model.new(rng.integers(1, 50, 70).astype(float), 20.0)
    docs = [np.append(rng.integers(1, 71, rng.integers(3, 40)), 0).astype(np.int32) for _ in range(5)]
    check_gradient(m, docs, lambda seen: (("u", (3, 5)), ("x", (int(seen[0, 0]), 40)), ("cw", (2, 1)), ("ww", (0, 4, 3)), ("b", (20,)), ("b", (40,)), ("cb", (1,)), ("wb", (1, 2))))


def test_language_model_tells_tail_words_apart():
    rng = np.random.default_rng(0)
    masses = rng.uniform(0.5, 9, 81)
    m = recurrent_lm.Model.new(np.array([50.0, 400, 300]), masses.sum(), slots=masses)
    states = rng.normal(size=(3, recurrent_lm.UNITS)).astype(np.float32)
    for s in states:
        assert abs(np.exp(m.log_probs(np.repeat(s[None], 84, 0), np.arange(84))).sum() - 1) < 1e-4
    docs = [np.append(rng.integers(1, 84, rng.integers(3, 40)), 0).astype(np.int32) for _ in range(5)]
    check_gradient(m, docs, lambda seen: (("xr", (4, 20)), ("xc", (5, 3)), ("tw", (3, 1)), ("tw", (2, 8)), ("u", (3, 5))))
    # two tail words that follow each other: the order is learned
    m = recurrent_lm.Model.new(np.array([50.0, 400, 300]), 3000.0, slots=np.full(81, 10.0))
    docs = [np.array([13, 64] * 20 + [0], np.int32) for _ in range(64)]
    m, _ = recurrent_lm.train(m, [docs] * 30, lanes=16)
    right, wrong = recurrent_lm.score_docs(m, [docs[0], np.array([13, 13, 64, 64] * 10 + [0], np.int32)])
    assert right > wrong + 40


def test_language_model_averages_in_a_tree(spark, docs, monkeypatch):
    """Parameters of many partitions meet a few at a time, and weigh by tokens."""
    import pyarrow as pa

    rows = [(np.full(3, float(i), np.float32), i + 1) for i in range(9)]
    out = next(recurrent_lm._average([recurrent_lm._params_row(v, n) for v, n in rows]))
    assert out.column(1)[0].as_py() == 45 and np.allclose(np.frombuffer(out.column(0)[0].as_py(), np.float32), sum(i * (i + 1) for i in range(9)) / 45)
    assert list(recurrent_lm._average([])) == [] and isinstance(out, pa.RecordBatch)


def test_language_model_slots_follow_the_vocabulary(spark):
    counts = Counter({f"w{i}": 1 + i % 9 for i in range(9000)}) + Counter({recurrent_lm.END: 50})
    v = recurrent_lm._vocabulary(spark.createDataFrame(list(counts.items()), "word string, n long"))
    often = sum(n >= 5 for n in counts.values()) - v.k
    assert 0.5 * often < len(v.slots) < 2 * often
    masses = np.full(len(v.slots), 0.5)
    for w in counts.keys() - set(v.words[: v.k]):
        masses[zlib.crc32(w.encode()) % len(masses)] += counts[w] + 0.5
    assert np.allclose(v.slots, masses)


# pipeline


def kept_by_plain_python(rows):
    """(doc_id, text) of rows that pass the quality rules: of equal texts the first, of linked ones the first."""
    owners = {i for i, _, _, own, _ in brute_owners(rows) if own}
    rows = [(i, t) for i, t in rows if i in owners]
    first = brute_components(rows)
    return [(i, t) for i, t in rows if first[i][1] == i]


def test_pipeline_agrees_with_plain_python(spark, docs, sf_dir):
    """Every piece of every document that stays: kept, redacted, tokenized and cut as by plain Python; each sequence without a gap."""
    rows = kept_by_plain_python([(r.doc_id, r.text) for r in docs.collect() if plain_quality(r.text)])
    stage = spark.createDataFrame(rows, "doc_id long, text string")
    weights = pii.fit(stage)
    tokenizer = Tokenizer.from_file(vocabulary_path("word_bpe_49k.json"))
    tokenizer.no_truncation(), tokenizer.no_padding()
    want = Counter()
    for i, text in rows:
        ids = np.array([*tokenizer.encode(pii.redact_text(text, weights), add_special_tokens=False).ids, 1], "<u4")
        want.update((i, piece, s, len(ids[s : s + 4096]), zlib.crc32(ids[s : s + 4096].tobytes())) for piece, s in enumerate(range(0, len(ids), 4096)))
    got = corpus_pipeline.run(spark, sf_dir).toPandas().sort_values(["sequence_id", "offset"])
    assert rows and Counter(zip(got.doc_id, got.piece, got.start, got.length, got.ids_crc32)) == want
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all() and got.groupby("sequence_id").length.sum().max() <= 4096


def plain_quality(text):
    """Whether a text passes every quality rule."""
    n_words, chars, symbols, dup_lines, repeated, _ = brute_quality(text)
    words, lines = WORD.findall(text or ""), [x for x in (text or "").split("\n") if WORD.search(x)]
    value = {
        "n_words": n_words, "one": 1, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines, "n_repeat_words": repeated, "n_lines": len(lines), "n_shouts": (text or "").count("!"),
        "n_stop_words": sum(w.lower() in quality_rules.STOP_WORDS for w in words), "n_bullet_lines": sum(bool(re.match(r"\s*[-*•]", x)) for x in lines), "n_ellipsis_lines": sum(bool(re.search(r"(\.\.\.|…)\s*$", x)) for x in lines),
    }
    for r in quality_rules.RULES:
        num, den = 1000 * value[r.numerator], value[r.denominator]
        if (r.low is not None and num < den * r.low) or (r.high is not None and num > den * r.high):
            return False
    return True


def test_pipeline_stages_on_odd_rows(spark, odd, empty, sf_dir):
    """Every stage but the last keeps the columns of its input, and each does to odd rows what the pipeline states."""
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, sf_dir)
        assert (name == "packing" or out.columns == empty.columns) and out.count() == 0
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda rows: Counter(r.doc_id for r in rows.collect())
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    # null, empty and blank texts fail the rules
    good = " ".join(f"The word{i} of that day and {i} more." for i in range(30))
    more = odd.unionByName(odd.limit(1).withColumns({"doc_id": F.lit(77).cast("long"), "text": F.lit(good)}))
    assert ids(stages["quality_rules"](spark, more, sf_dir)) == Counter([77, *[i for i, t in rows if plain_quality(t)]])
    # of equal texts the rows with the smallest identifier
    want = Counter(i for i, keep, _, _, _ in brute_owners(rows) if i == keep)
    assert ids(stages["exact_dedup"](spark, odd, sf_dir)) == want
    # near copies: 3 repeats 2 but for its end; the one without an identifier and a repeated identifier stay
    base = " ".join(f"w{i}" for i in range(60))
    near = [(2, base), (3, base + " end"), (4, None), (4, None), (None, base), (5, "w1 w2"), (6, "w1 w2"), (7, ""), (8, "")]
    first = odd.limit(1).drop("doc_id", "text").crossJoin(spark.createDataFrame(near, "doc_id long, text string")).select(odd.columns)
    assert ids(stages["jaccard_join"](spark, first, sf_dir)) == Counter([2, 4, 4, None, 5, 7, 8])
    # redaction keeps every row; a text without personal data stays as it is
    out = stages["pii"](spark, odd, sf_dir)
    assert ids(out) == Counter(i for i, _ in rows)
    assert Counter(r.text for r in out.collect() if "[" not in (r.text or "")) == Counter(t for _, t in rows if "[" not in pii.redact_text(t or ""))
    if "n_chars" in odd.columns:
        assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in out.collect())
