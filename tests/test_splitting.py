"""Files read in byte ranges, against the csv and json modules."""

import csv
import io
import json

import numpy as np
import pytest

from quarry.sources import files, splitting


@pytest.fixture()
def ranges(spark):
    """Ranges of so many bytes."""
    conf = {"spark.sql.files.openCostInBytes": "1"}
    kept = {k: spark.conf.get(k) for k in (*conf, "spark.sql.files.maxPartitionBytes")}

    def of(n):
        for k, v in (conf | {"spark.sql.files.maxPartitionBytes": str(n)}).items():
            spark.conf.set(k, v)

    yield of
    for k, v in kept.items():
        spark.conf.set(k, v)


def field(rng):
    return "".join(rng.choice(['"', ",", "\n", "\r\n", "a", "é日", " ", "\\", "#", "x" * 9], rng.integers(0, 9)))


def table(rng, n, columns):
    out = io.StringIO(newline="")
    w = csv.DictWriter(out, columns, lineterminator=str(rng.choice(["\n", "\r\n"])))
    w.writeheader()
    rows = [{c: field(rng) for c in columns} for _ in range(n)]
    w.writerows(rows)
    return out.getvalue(), rows


@pytest.mark.parametrize("size", [7, 64, 1000, 1 << 20])
def test_csv_in_ranges(spark, tmp_path, ranges, size):
    rng, want = np.random.default_rng(size), []
    for k, columns in enumerate((["a", "b", "c"], ["c", "a"], ["b", "x", "a"])):
        text, rows = table(rng, 60 if size > 7 else 15, columns)
        (tmp_path / f"{k}.csv").write_bytes(text.encode())
        want += [tuple(r.get(c, "") for c in "abc") for r in rows]
    ranges(size)
    got = files.read_csv(spark, str(tmp_path), "a string, b string, c string")
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_quote_over_many_ranges(spark, tmp_path, ranges):
    """A field that opens in one range and closes three later, between short records."""
    long = ('say "yes",\n' * 40).strip()
    with open(tmp_path / "m.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerows([["k", "v"], *([str(i), "x"] for i in range(20)), ["long", long], *([str(i), '"'] for i in range(20)), ["last", "no newline\nafter"]])
    ranges(100)
    assert (tmp_path / "m.csv").stat().st_size > 700
    got = {r.k: r.v for r in files.read_csv(spark, str(tmp_path), "k string, v string").collect()}
    assert len(got) == 22 and got["long"] == long and got["7"] == '"' and got["last"] == "no newline\nafter"


def test_ranges_meet_by_a_shuffle_too(spark, tmp_path, ranges, monkeypatch):
    text, rows = table(np.random.default_rng(2), 50, ["a", "b"])
    (tmp_path / "x.csv").write_bytes(text.encode())
    monkeypatch.setattr(splitting, "BROADCAST_RANGES", 0)
    ranges(90)
    got = files.read_csv(spark, str(tmp_path), "a string, b string")
    assert sorted(map(tuple, got.collect())) == sorted((r["a"], r["b"]) for r in rows)


def test_odd_csv(spark, tmp_path):
    cases = {"empty.csv": b"", "head.csv": b"a,b\r\n", "blank.csv": b"a,b\n\n1,2\n\r\n3\n", "open.csv": b'a,b\n5,"never closed\n6,7\n'}
    for name, data in cases.items():
        (tmp_path / name).write_bytes(data)
    got = files.read_csv(spark, str(tmp_path), "b string, a string, z string")
    assert sorted(map(tuple, got.collect())) == sorted([("2", "1", ""), ("", "3", ""), ("never closed\n6,7", "5", "")]) or sorted(map(tuple, got.collect())) == sorted([("2", "1", ""), ("", "3", ""), ("never closed\n6,7\n", "5", "")])
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "e.csv").write_bytes(b"")
    assert files.read_csv(spark, str(tmp_path / "none"), "a string").collect() == []


CAPTION = {"caption": 'a "quoted", {odd} [one] \\ back\\\\" slash', "should_reject": True, "reject_signals": ["x,y", "}"], "error": None}


@pytest.mark.parametrize("size", [11, 100, 3000, 1 << 20])
@pytest.mark.parametrize("indent", [None, 2])
def test_objects_in_ranges(spark, tmp_path, ranges, size, indent):
    rng = np.random.default_rng(size)
    n = 12 if size == 11 else 80
    entries = {f'k{i}," {{{"é" * int(rng.integers(0, 5))}': {k: v for k, v in CAPTION.items() if rng.random() < 0.7} for i in range(n)}
    entries["text"] = {"caption": "".join(rng.choice(list('"\\,{}[]: \n日'), 300))}
    (tmp_path / "c.json").write_text(json.dumps(entries, indent=indent, ensure_ascii=bool(rng.random() < 0.5)))
    (tmp_path / "d.json").write_text(" {} \n")
    (tmp_path / "e.json").write_text('{"other": {"error": "late"}}\n')
    ranges(size)
    got = {r.filename: {k: r[k] for k in CAPTION} for r in files.read_captions(spark, str(tmp_path)).collect()}
    assert got == {k: {f: v.get(f) for f in CAPTION} for k, v in (entries | {"other": {"error": "late"}}).items()}


def test_object_of_strings(spark, tmp_path, ranges):
    entries = {f"f{i}.png": ["ai_art", "me,me"][i % 2] for i in range(300)}
    (tmp_path / "c.json").write_text(json.dumps(entries))
    ranges(500)
    found = files.read_classifications(spark, str(tmp_path / "c.json"))
    assert {r.filename: r.category for r in found.collect()} == entries
    assert files.read_classifications(spark, str(tmp_path / "no.json")).collect() == []
