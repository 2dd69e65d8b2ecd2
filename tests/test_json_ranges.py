"""Large array files, read in byte ranges."""

import json

import numpy as np
import pyarrow as pa
import pytest

from agentlake.sources import json_ranges, load_events
from agentlake.sources.json_ranges import STATES, array_file_elements, chain, elements, scan, summarise
from agentlake.sources.json_tree import EVENT_FILES, read_files

VALUES = [{"a": "x,]}[{\\\"", "b": [1, [2, {"c": "\\"}]]}, "s,\\", 12, None, [], {}, "é€\"", {"k": "\\\\\""}, [[["]"]]], True, "\\" * 9 + '"' * 5]
TEXTS = [json.dumps(VALUES), json.dumps(VALUES, indent=2, ensure_ascii=False), "[]", "  [ ] \n", "[1]", ' [ "" , [ ] ] ', json.dumps([VALUES] * 3)]


def array(raw):
    return np.frombuffer(raw, np.uint8)


def by_ranges(raw, size):
    """What the two readings give, one range after the other."""
    found, state, depth, opened, commas = [], 0, 0, 0, 0
    for low in range(0, len(raw), size):
        high = min(low + size, len(raw))
        found += elements(lambda at, n: raw[at : at + n], low, high, state, depth, commas, opened > 0)
        own = summarise(array(raw[low:high]))[state]
        commas += own.commas[1 - depth]
        state, depth, opened = own.end, depth + own.depth, opened + own.opened
    return found


@pytest.mark.parametrize("text", TEXTS)
def test_sums_chain_at_every_byte(text):
    raw = text.encode()
    whole = summarise(array(raw))
    for cut in range(len(raw) + 1):
        assert chain(summarise(array(raw[:cut])), summarise(array(raw[cut:]))) == whole
    assert whole[0].end == whole[0].depth == 0


@pytest.mark.parametrize("chunk", [1, 5, 1 << 20])
@pytest.mark.parametrize("text", TEXTS)
def test_ranges_of_every_size_give_the_same_elements(text, chunk, monkeypatch):
    monkeypatch.setattr(json_ranges, "CHUNK_BYTES", chunk)
    raw = text.encode()
    for size in range(1, min(len(raw), 120) + 2):
        found = by_ranges(raw, size)
        assert [k for k, _ in found] == list(range(len(found))) and [json.loads(t) for _, t in found] == json.loads(raw)


def test_scan_against_a_plain_loop():
    r = np.random.default_rng(3)
    for _ in range(3000):
        raw = bytes(r.choice(list(b'\\\\"[]{},a'), r.integers(0, 14)).tolist())
        for state in STATES:
            inside, escaped, places = state & 1, state & 2, []
            for k, c in enumerate(raw):
                if escaped:
                    escaped = 0
                elif c == 0x5C:
                    escaped = 2
                    continue
                elif c == 0x22:
                    inside ^= 1
                if c in b"[]{}," and not inside:
                    places.append(k)
            at, end = scan(array(raw), state)
            assert (at.tolist(), end) == (places, inside + escaped), (raw, state)


@pytest.mark.parametrize("text", ["{}", "[1]]", "[1][2]", "[1}", "x[1]", "[1] 2", "[1,,2]", "[,1]", "[1,]", "[1", "", "12", '"[1]"', "[1, 2"])
def test_what_is_no_array_is_refused(spark, tmp_path, text):
    path = tmp_path / "a.json"
    path.write_text(text + " ")
    files = spark.createDataFrame([(f"file:{path}", len(text) + 1)], "path string, length long")
    for size in (2, 100):
        with pytest.raises(Exception, match="not a JSON array"):
            array_file_elements(files, size).collect()


def test_files_in_spark(spark, tmp_path):
    paths = []
    for k, text in enumerate(TEXTS):
        path = tmp_path / f"a b+%{k}.json"
        path.write_text(text)
        paths.append((f"file:{path}", len(text.encode())))
    files = spark.createDataFrame(paths, "path string, length long")
    for size in (3, 64, 10_000):
        got = {}
        for row in array_file_elements(files, size).collect():
            got.setdefault(row.path, {})[row.position] = json.loads(row.element)
        for (path, _), text in zip(paths, TEXTS):
            own = got.get(path, {})
            assert [own[k] for k in range(len(own))] == json.loads(text)
    assert array_file_elements(files.limit(0)).collect() == []


def test_large_event_files_load_like_small_ones(spark, tmp_path):
    def event(k):
        return {"event_id": k, "session_id": "" if k % 3 else f"s{k}", "content": {"timestamp": f"2024-01-0{k % 9 + 1}T00:00:00", "action": "run", "args": {"text": '"],[{' * (k % 7) + "é\\"}}}

    for a, n in (("app-1", 400), ("app-2", 3), ("app-3", 0)):
        folder = tmp_path / "logs" / a / "conv-x y"
        folder.mkdir(parents=True)
        (folder / "events.json").write_text(json.dumps([event(k) for k in range(n)], indent=1, ensure_ascii=False))
        (tmp_path / "logs" / a / "conversations.json").write_text(json.dumps([{"id": "conv-x y", "llm_model": f"model of {a}"}]))
    whole = load_events(spark, str(tmp_path / "logs"))
    expected = sorted(map(str, whole.collect()))
    assert len(expected) == 403
    for size in (13, 50, 1000, 20_000):
        parts = load_events(spark, str(tmp_path / "logs"), whole_bytes=size)
        assert parts.schema == whole.schema and sorted(map(str, parts.collect())) == expected
    small = read_files(spark, str(tmp_path / "logs"), EVENT_FILES, 2000)
    assert sorted(r.app_dir for r in small.collect()) == ["app-2", "app-3"]
    plan = small._jdf.queryExecution().executedPlan()
    assert "file_size" in plan.toString()


def test_a_damaged_large_file_stops_the_load(spark, tmp_path):
    folder = tmp_path / "logs" / "app-1" / "conv-1"
    folder.mkdir(parents=True)
    for text in ('[{"event_id": 1}, {"event_id": 2}', '[{"event_id": 1}, {"event_id": }]', '[{"event_id": 1}, {"a" "b"}]'):
        (folder / "events.json").write_text(text)
        with pytest.raises(Exception):
            load_events(spark, str(tmp_path / "logs"), whole_bytes=8).collect()


def test_schemas_name_known_kinds():
    assert json_ranges._arrow(json_ranges.SUMS).field("levels").type == pa.list_(pa.int64())


def test_sums_leave_a_task_in_parts(tmp_path, monkeypatch):
    """Not those of all ranges of a batch at once."""
    (tmp_path / "x.json").write_bytes(raw := json.dumps(VALUES * 20).encode())
    monkeypatch.setattr(json_ranges, "BATCH_RANGES", 3)
    lows = list(range(0, len(raw), 64))
    ranges = pa.RecordBatch.from_pydict({"path": [str(tmp_path / "x.json")] * len(lows), "low": lows, "high": [min(at + 64, len(raw)) for at in lows]})
    parts = list(json_ranges._summarise_ranges(iter([ranges])))
    assert max(p.num_rows for p in parts) == 3 * len(STATES)
    assert [r["low"] for p in parts for r in p.to_pylist()] == [at for at in lows for _ in STATES]
