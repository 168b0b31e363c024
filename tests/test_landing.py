"""Landing of damaged, odd and large files."""

from __future__ import annotations

import json
import random

import pytest

from veleta import contracts
from veleta.sources import raw

TEXTS = ["x", "a}b", "{[", 'q"uote', "back\\slash\\", '\\"}', "é日", "]},{", "", '"items": [', "tab\t\n"]
BAD = {
    "s0/cut.json": '{"a":1', "s0/comma.json": '[{"a":1},{"b" 2}]', "s1/glued.json": '[{"a":1}{"b":2}]', "s1/more.json": '[{"a":1}]}', "s1/two.json": '[{"a":1}] [2]',
    "s1/number.json": '{"items": 5}', "s2/quote.json": '[{"a":"x}]',
}


def value(draw: random.Random, depth: int = 0):
    kind = draw.random()
    if kind < 0.4:
        return draw.choice(TEXTS)
    if kind < 0.6:
        return draw.choice([1, 2.5, None, True])
    if kind < 0.8 and depth < 3:
        return {draw.choice(["a", "items", "b}", 'c"']): value(draw, depth + 1) for _ in range(draw.randrange(3))}
    return [value(draw, depth + 1) for _ in range(draw.randrange(3))] if depth < 3 else 0


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Lists and envelopes of random objects under a root with odd characters, and files that are damaged."""
    root, draw, good = tmp_path_factory.mktemp("raw") / "a+b(1) é%20", random.Random(1), {}
    for i in range(40):
        items = [{draw.choice("abcde") + str(k): value(draw) for k in range(draw.randrange(4))} for _ in range(draw.randrange(6))]
        whole = {"meta": {"items": [{"z": 1}], "t": value(draw)}, "e": [{"q": 1}], "items": items, "more": [{"x": 2}], "n": {}}
        made = (items, {"items": items}, whole, items)[i % 4]
        text = json.dumps(made, ensure_ascii=i % 3 == 0, indent=draw.choice([None, 2]))
        good[f"s{i % 3}/f{i}.json"] = (text if i % 4 < 3 else f"\n {text}\n", items)
    for name, text in {**{n: t for n, (t, _) in good.items()}, **BAD, "top.json": '{"a":1}'}.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)
    (root / "s0" / "bytes.json").write_bytes(b'[{"a":"\xff\xfe"}]')
    return str(root), {n: items for n, (_, items) in good.items()}


def shown(records):
    out = {}
    for r in records.collect():
        reason, found = out.setdefault(r.ruta, [r.reason, {}])
        assert reason == r.reason
        if r.place is not None:
            found[r.place] = json.loads(r.raw_data)
    return {n: (reason, [found[i] for i in sorted(found)]) for n, (reason, found) in out.items()}


def test_whole_files(spark, folder):
    root, good = folder
    got = shown(raw.read_json(spark, root, "*.json"))
    assert {n: got[n] for n in good} == {n: (None, items) for n, items in good.items()}
    assert {n for n, (reason, _) in got.items() if reason} == {*BAD, "s0/bytes.json"}
    assert got["top.json"] == (None, [{"a": 1}])


@pytest.mark.parametrize("piece", ["300", "64m"])
def test_files_in_segments(spark, folder, piece):
    """The same records from byte ranges of a few hundred bytes; single objects are no lists."""
    root, good = folder
    before = {c: spark.conf.get(c) for c in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        records = raw.split_records(spark, root, "*.json", least=0)
        got, digests = shown(records), {r.ruta: r.hash_sha256 for r in records.collect()}
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
    assert {n: got[n] for n in good} == {n: (None, items) for n, items in good.items()}
    assert {n for n, (reason, _) in got.items() if reason} == {*BAD, "s0/bytes.json", "top.json"}
    assert len(set(digests.values())) <= len(digests) and all(len(d) == 64 for d in digests.values())
    assert digests == {r.ruta: r.hash_sha256 for r in raw.split_records(spark, root, "*.json", least=0).collect()}  # ranges do not matter


def test_rejected_files_are_tried_again(spark, tmp_path):
    (tmp_path / "github").mkdir()
    (tmp_path / "github" / "good.json").write_text('[{"a": 1}, {"a": 2}]')
    (tmp_path / "github" / "empty.json").write_text('{"items": []}')
    bad = tmp_path / "github" / "bad.json"
    bad.write_text('[{"a": 3}')
    files, records, rejected = raw.land(raw.read_json(spark, str(tmp_path), "*.json"), spark.createDataFrame([], contracts.RAW_FILES), "r1")
    assert sorted((r.ruta, r.registros) for r in files.collect()) == [("github/empty.json", 0), ("github/good.json", 2)] and records.count() == 2
    assert [(r.ruta, r.reason, r.run_id) for r in rejected.collect()] == [("github/bad.json", raw.DAMAGED, "r1")]
    bad.write_text('[{"a": 3}]')
    again, more, none = raw.land(raw.read_json(spark, str(tmp_path), "*.json"), files, "r2")
    assert [(r.ruta, r.id) for r in again.collect()] == [("github/bad.json", 3)] and more.count() == 1 and none.count() == 0


def test_a_folder_of_sources_and_nothing_to_land(spark, folder, tmp_path):
    root, good = folder
    assert {r.fuente for r in raw.read_json(spark, root, "*.json", ["s1"]).collect()} == {"s1"}
    assert {r.fuente for r in raw.read_json(spark, root, "top*").collect()} == {raw.UNKNOWN_SOURCE}
    assert raw.read_json(spark, str(tmp_path), "*.json").count() == 0
