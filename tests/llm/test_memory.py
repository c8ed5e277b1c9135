"""What a task leaves in its Python worker, which outlives it."""

import gc
import os

import public_tokenizers
import pyarrow as pa
import wattline.llm as llm
from wattline.llm import packing


def resident():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE") >> 20


def test_tidy_returns_arrow_memory():
    held = [pa.array(bytes(1 << 20) for _ in range(16)) for _ in range(10)]
    full = resident()
    del held
    llm.tidy()
    assert pa.default_memory_pool().bytes_allocated() < 100 << 20 and full - resident() > 100


def test_packing_leaves_no_words_and_one_tokenizer(spark, frame, monkeypatch):
    docs = frame([(1, "One. Two."), (2, None)])
    tasks, left, loaded = [], [], []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, task, schema: tasks.append(task))
    packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), remember=False)
    monkeypatch.undo()

    def look():
        gc.collect()
        left.append([x for x in gc.get_objects() if isinstance(x, packing._Held) or isinstance(x, packing._Store) and x.size > 1])

    load = packing.WordEncoder.__init__
    monkeypatch.setattr(packing.WordEncoder, "__init__", lambda self, path: loaded.append(path) or load(self, path))
    monkeypatch.setattr(packing, "_ENCODERS", {})
    for module in (llm, packing):
        monkeypatch.setattr(module, "tidy", look, raising=False)
    monkeypatch.setattr(packing, "TaskContext", type("Context", (), {"get": lambda: type("Task", (), {"partitionId": lambda: 0})}))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["One. Two.", None])], names=["doc_id", "_text"])
    first, second = (pa.Table.from_batches(tasks[0](iter([batch]))) for _ in range(2))
    assert first.equals(second) and set(first["doc_id"].to_pylist()) == {1, 2}
    assert left == [[], []] and len(loaded) == 1


def test_a_task_that_forgets_holds_few_words(spark, frame, monkeypatch):
    docs = frame([(1, "a")])
    tasks, held = [], []
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, task, schema: tasks.append(task))
    for remember in (True, False):
        packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), remember=remember)
    monkeypatch.undo()
    learn = packing.WordEncoder.learn
    monkeypatch.setattr(packing.WordEncoder, "learn", lambda self, new: learn(self, new) or held.append(self.words.size))
    monkeypatch.setattr(packing, "_ENCODERS", {})
    monkeypatch.setattr(packing, "SLICE", 1)  # a text at once
    monkeypatch.setattr(packing, "TASK_CACHE", 8, raising=False)
    monkeypatch.setattr(packing, "TaskContext", type("Context", (), {"get": lambda: type("Task", (), {"partitionId": lambda: 0})}))
    texts = [" ".join(f"w{i}x{j}." for j in range(5)) + " w0x0." for i in range(6)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], names=["doc_id", "_text"])
    for task, most in ((tasks[0], 31), (tasks[1], 14)):
        held.clear()
        rows = pa.Table.from_batches(task(iter([batch])))
        assert max(held) <= most
    assert rows.equals(pa.Table.from_batches(tasks[0](iter([batch]))))
