"""Conversation repair, sentence pieces and periodic runs against brute force, the library, and on odd inputs."""

from __future__ import annotations

import random
from hashlib import sha256
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest

from veleta.llm import conversations, periodic_runs, queries, sentencepieces

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def digest(text: str | bytes) -> str:
    return sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# Conversation repair.


def damaged_rows(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        which = crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if which == 0:
            continue
        text = "" if which == 1 else text.translate({ord(c): None for c in ".!?"}) if which == 2 else text
        out += [(conv, turn, "user" if which == 4 else role, text)] * (2 if which == 3 else 1)
    return out


def cheapest(rows: list[tuple[str, str, str]]) -> tuple[int, str, list[tuple[str, str]]]:
    """Cost, letters and rows of the best repair of (role, text, fault), by whole suffixes."""
    states = ("", "s", "u", "a")
    best: dict[tuple[int, str], tuple[int, str, tuple]] = {}
    for i in range(len(rows), -1, -1):
        here = {q: [] for q in states}
        for q in states:
            turn = "assistant" if q == "u" else "user"
            if i == len(rows):
                if q in ("", "a"):
                    here[q].append((0, "", ()))
                continue
            role, text, fault = rows[i]
            c, s, done = best[i + 1, q]
            here[q].append((c + 4, "D" + s, done))
            if fault in ("blank", "duplicate"):
                continue
            extra, initial = 3 * (fault == "truncated"), role[:1]
            legal = {"": "su", "s": "u", "u": "a", "a": "u"}[q]
            if initial and initial in legal:
                c, s, done = best[i + 1, initial]
                here[q].append((c + extra, "K" + s, ((role, text), *done)))
            c, s, done = best[i + 1, turn[0]]
            here[q].append((c + 3 + extra, "R" + s, ((turn, text), *done)))
        for _ in range(3):  # insertions
            for q in states:
                turn = "assistant" if q == "u" else "user"
                if here[turn[0]]:
                    c, s, done = min(here[turn[0]])
                    here[q].append((c + 3, "I" + s, ((turn, ""), *done)))
        for q in states:
            best[i, q] = min(here[q])
    return best[0, ""]


def plain_report(rows):
    out = {}
    after = damaged_rows(rows)
    for conv in {r[0] for r in rows}:
        mine = [r for r in after if r[0] == conv]
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, sha256(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).digest()))
        seen, judged = set(), []
        for _, _, role, text in mine:
            spoken = text.strip(" \t\n\x0b\x0c\r")
            fault = "blank" if not spoken else "duplicate" if (role, text) in seen else "" if spoken[-1] in ".!?" else "truncated"
            seen.add((role, text))
            judged.append((role, text, fault))
        turns = [r[1] for r in mine if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        count = lambda f: sum(j[2] == f for j in judged)  # noqa: E731, B023
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:]))
        cost, audit, done = cheapest(judged)
        out[conv] = (gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit, digest("\n".join(f"{r}:{t}" for r, t in done)))
    return out


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def found_report(df):
    return {r["conv_id"]: tuple(r[n] for n in NAMES) for r in df.collect()}


def random_conversations(seed: int, n: int, longest: int):
    draw = random.Random(seed)
    rows = []
    for conv in range(n):
        for turn in range(draw.randrange(1, longest)):
            role = draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            rows.append((conv, draw.choice([turn, turn, turn, None, turn - 1]), role, draw.choice(["Yes.", "No", "So?", "", " \n", None, f"t{turn}!", f"w{turn}"])))
    return rows


def test_repair_of_short_conversations(spark):
    rows = [*random_conversations(1, 120, 9), (None, 0, "user", "Hm."), (None, 1, "assistant", "So."), (None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    assert found_report(conversations.report(spark, df)) == plain_report(rows)


@pytest.mark.parametrize("ranges", [1, 13])
def test_repair_of_a_conversation_in_many_tasks(spark, ranges):
    draw = random.Random(4)
    words = ["a.", "b", "c!", "", "d?"]
    rows = [(7, t, draw.choice(["user", "assistant", "user", "assistant", "system"]), draw.choice(words) + str(draw.randrange(60)) * draw.randrange(2)) for t in range(300)]
    rows += [(t % 5 + 10, t, "user", f"{t}.") for t in range(20)] + [(8, 0, "user", "same.")] * 40
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(2)
    before = {c: spark.conf.get(c) for c in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert found_report(conversations.report(spark, df)) == plain_report(rows)
        repaired, summary = conversations.repair(spark, df)
        by_letter = {r["key"]: r["audit"] for r in summary.collect()}
        for key in ("=7", "=8"):
            mine = repaired.filter(f"key = '{key}'").orderBy("part", "seq").collect()
            assert "".join(r["edit"] for r in mine) == by_letter[key]
            stays = "".join(r["role"][0] for r in mine if r["edit"] != "D")
            assert stays.lstrip("s").replace("ua", "") == ""
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)


def test_speculative_vectors_are_fixed_until_they_fit(spark):
    """Rows of foreign roles carry a difference of costs over whole chunks, so that one pass is not enough."""
    codes = bytes([conversations.code_of("assistant", 0)] + [conversations.code_of("x", conversations.BLANK)] * 20 + [conversations.code_of("user", 0)])
    cuts = [codes[i : i + 4] for i in range(0, len(codes), 4)]
    chunks = spark.createDataFrame([("k", i, bytearray(c), None) for i, c in enumerate(cuts)], "key string, part int, codes binary, late array<long>")
    ends = {r["part"]: tuple(r["end"]) for r in conversations.converge(spark, chunks).collect()}
    exact = conversations.backward(codes, conversations.END)
    for i in range(len(cuts)):
        assert ends[i] == conversations.normal(exact[min(len(codes), 4 * (i + 1))])


def test_repair_of_nothing_and_of_clashing_columns(spark):
    schema = "conv_id string, turn int, role string, text string, key string, part int, audit string, cost double"
    none = spark.createDataFrame([], schema)
    assert conversations.report(spark, none).count() == 0
    rows = [("a", 0, "user", "Hi.", "x", 1, "y", 0.5), ("a", 1, "assistant", "Ho.", None, None, None, None)]
    got = found_report(conversations.report(spark, spark.createDataFrame(rows, schema)))
    assert got == plain_report([r[:4] for r in rows])


def test_repair_query(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found_report(queries.op11_conversation_repair(spark, sf_dir)) == plain_report(rows)


# Sentence pieces.


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def pieces_as_library(path: str, texts: list[str]) -> None:
    import sentencepiece

    sp, model = sentencepiece.SentencePieceProcessor(model_file=path), sentencepieces.Model(path)
    for text, (ids, ends) in zip(texts, model.encode(texts)):
        want = sp.encode(text, add_bos=True, add_eos=True)
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert model.decode(ids) == sp.decode(want), text
        raw, at = text.encode(), np.frombuffer(ends, "<u4").tolist()
        surfaces = [raw[a:b].decode() for a, b in zip(at, at[1:-1])]
        assert surfaces == [p.surface for p in sp.encode(text, return_type="proto").pieces], text


def odd_texts(seed: int, n: int) -> list[str]:
    draw, letters = random.Random(seed), "abcdeé ▁  \t\n日本😀ñ.!<s>0123é́ｱﾞﬁ① 　​\u0000­"
    fixed = ["", " ", "  ", " a", "a ", "▁", "<s></s><unk>", "<0x41>", "x" * 3000, "▁" * 100, " " * 500 + "a", "日" * 200, "😀" * 80]
    return fixed + ["".join(draw.choice(letters) for _ in range(draw.randrange(60))) for _ in range(n)]


def test_pieces_are_those_of_the_library():
    pieces_as_library(PIECES, odd_texts(1, 500))


@pytest.mark.parametrize("rules", ["nmt_nfkc", "nfkc_cf"])
@pytest.mark.parametrize("prefix", [True, False])
@pytest.mark.parametrize("squeeze", [True, False])
def test_pieces_under_a_character_map(tmp_path, rules, prefix, squeeze):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as formats

    made, known = formats.ModelProto(), formats.ModelProto()
    with open(PIECES, "rb") as f:
        made.ParseFromString(f.read())
    known.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rules).serialized_model_proto())
    made.normalizer_spec.precompiled_charsmap = known.normalizer_spec.precompiled_charsmap
    made.normalizer_spec.add_dummy_prefix, made.normalizer_spec.remove_extra_whitespaces = prefix, squeeze
    path = tmp_path / "made.model"
    path.write_bytes(made.SerializeToString())
    pieces_as_library(str(path), odd_texts(2, 200))


def test_decoding_of_any_identifiers(library):
    draw, model = random.Random(5), sentencepieces.Model(PIECES)
    for _ in range(400):
        ids = [draw.choice([draw.randrange(32000), draw.randrange(259), library.piece_to_id("▁")]) for _ in range(draw.randrange(9))]
        assert model.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids)


def test_other_models_are_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as formats

    made = formats.ModelProto()
    with open(PIECES, "rb") as f:
        made.ParseFromString(f.read())
    made.trainer_spec.byte_fallback = False
    (tmp_path / "other.model").write_bytes(made.SerializeToString())
    with pytest.raises(ValueError):
        sentencepieces.Model(str(tmp_path / "other.model"))


def test_pieces_of_odd_rows(spark, odd, empty, library):
    clashing = odd.withColumns({"ids": odd["n"], "ends": odd["n"], "decoded": odd["n"]})
    rows = sentencepieces.round_trip(clashing, PIECES).collect()
    texts = {(r["doc_id"], r["text"]) for r in odd.collect()}
    want = sorted((str(i), digest(np.array(library.encode(t or "", add_bos=True, add_eos=True), "<u4").tobytes()), t or "") for i, t in texts)
    assert sorted({(str(r["doc_id"]), digest(r["ids"]), r["decoded"]) for r in rows}) == want
    assert len(rows) == odd.count()
    assert sentencepieces.round_trip(empty, PIECES).count() == 0
    back = sentencepieces.decode(sentencepieces.encode(odd, PIECES), PIECES)
    assert sorted((str(r["doc_id"]), r["text"]) for r in back.collect()) == sorted((str(r["doc_id"]), r["decoded"]) for r in rows)


def test_pieces_query(spark, sf_dir, library):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    want = {}
    for d in docs:
        ids = library.encode(d["text"] or "", add_bos=True, add_eos=True)
        want[d["doc_id"]] = (len(ids), digest(np.array(ids, "<u4").tobytes()), digest(library.decode(ids)))
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in queries.op12_sentencepiece_round_trip(spark, sf_dir).collect()}
    assert got == want


# Periodic runs.


def brute_runs(words, least=24, times=3):
    """Runs by comparing words one period apart, period by period."""
    n, found = len(words), []
    for p in range(1, n // times + 1):
        i = 0
        while i + p < n:
            if words[i] != words[i + p]:
                i += 1
                continue
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            length = j - i + p
            if length >= max(least, times * p) and not any(q < p and words[i : i + length - q] == words[i + q : i + length] for q in range(1, p)):
                found.append((i, length, p))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_lyndon(codes):
    found = []
    for i in range(len(codes)):
        j = i + 1
        while j < len(codes) and codes[j:] > codes[i:]:
            j += 1
        found.append(j - i)
    return found


def test_lyndon_arrays_of_the_sorter():
    draw = random.Random(6)
    for _ in range(1500):
        codes = [draw.randrange(draw.choice([1, 2, 3, 6])) for _ in range(draw.randrange(1, 40))]
        if draw.random() < 0.5:
            codes = (codes[: draw.randrange(1, 9)] * 40)[: len(codes)]
        for sign in (1, -1):
            assert periodic_runs.lyndon_array(sign * np.array(codes)).tolist() == brute_lyndon([sign * c for c in codes])


@pytest.mark.parametrize("least,times", [(2, 3), (6, 3), (2, 4)])
def test_runs_from_roots(least, times):
    draw = random.Random(7)
    for _ in range(800):
        codes = [draw.randrange(draw.choice([1, 2, 3])) for _ in range(draw.randrange(1, 50))]
        assert periodic_runs.runs_of(np.array(codes), least, times) == brute_runs(codes, least, times)


def test_runs_in_stretches_of_long_texts():
    draw = random.Random(8)
    for _ in range(300):
        codes = [draw.randrange(300) for _ in range(draw.randrange(1, 300))]
        for _ in range(draw.randrange(4)):  # periodic parts that may touch or overlap, and a passage found twice
            a, p = draw.randrange(len(codes)), draw.randrange(1, 20)
            for i in range(a, min(len(codes), a + draw.randrange(20, 150))):
                codes[i] = codes[a + (i - a) % p]
        if len(codes) > 150:
            codes[100:140] = codes[20:60]
        assert periodic_runs.find_runs(np.array(codes)) == brute_runs(codes)


def plain_runs(doc_id, text):
    words = text.split(None) if text.isascii() else [w.decode() for w in text.encode().split()]
    h = crc32(str(doc_id).encode()) if doc_id is not None else 1
    n, g = len(words), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, length, p in runs for i in range(s + p, s + length)}
    best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=None)
    digests = digest("".join(f"{s},{length},{p}\n" for s, length, p in runs)), digest(" ".join(w for i, w in enumerate(words) if i not in dropped))
    return (len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], *digests)


RUN_NAMES = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")


def found_runs(df):
    return sorted((str(r["doc_id"]), tuple(r[n] for n in RUN_NAMES)) for r in df.collect())


def test_runs_of_odd_rows(spark, odd, empty):
    clashing = odd.withColumns({"runs": odd["n"], "collapsed": odd["n"], "n_words": odd["n"]})
    got = found_runs(periodic_runs.digest(periodic_runs.detect(clashing, change=periodic_runs.make_periodic)))
    assert got == sorted((str(r["doc_id"]), plain_runs(r["doc_id"], r["text"] or "")) for r in odd.collect())
    assert periodic_runs.digest(periodic_runs.detect(empty)).count() == 0


def test_the_greatest_exponent_and_its_ties(spark):
    """Two runs of the exponent 5, the first one counts; and 13/4 against 3, which rounded figures would tell as well."""
    rest = " ".join(f"w{i}" for i in range(40))
    texts = [f"{'a b c d e ' * 5} {rest} {'f g h i j k ' * 5}", f"{rest} {' '.join((['p q r s t u v w'] * 4))} p q", None]
    docs = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    got = found_runs(periodic_runs.digest(periodic_runs.detect(docs)))
    rows = {i: r for i, r in got}
    assert rows["-1"][:5] == (2, 0, 25, 5, 5000) and rows["-2"][:5] == (1, 40, 34, 8, 4250) and rows["-3"][:5] == (0, None, None, None, None)


def test_runs_query(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    short = {str(d["doc_id"]) for d in docs if len((d["text"] or "").split()) <= 1500}
    got = [r for r in found_runs(queries.op13_periodic_runs(spark, sf_dir)) if r[0] in short]
    want = sorted((str(d["doc_id"]), plain_runs(d["doc_id"], d["text"] or "")) for d in docs if str(d["doc_id"]) in short)
    assert got == want and len(short) > 100
