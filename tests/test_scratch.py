import re
from pathlib import Path

from passagemill.sources import scratch


def test_the_driver_gives_back_freed_native_memory(spark, monkeypatch):
    java = spark.sparkContext._jvm
    pid = java.java.lang.ProcessHandle.current().pid()
    resident = lambda: int(re.search(r"VmRSS:\s+(\d+)", Path(f"/proc/{pid}/status").read_text())[1]) / 1024
    for _ in range(3):  # what the first writes load
        scratch.discard(scratch.materialize(spark.range(10), "before"))
    # some 260 KB of malloc each; every 20th stays, so that what is free lies between
    held = [java.java.util.zip.Deflater() for _ in range(1000)]
    freed = [x for i, x in enumerate(held) if i % 20]
    for x in held:
        x.setInput(b"text" * 10_000)
        x.finish()
        x.deflate(bytearray(100))
    for x in freed:
        x.end()
    before = resident()  # with what is free
    monkeypatch.setattr(scratch, "_trimmed", float("-inf"))
    scratch.discard(scratch.materialize(spark.range(10), "trimmed"))
    after = resident()
    for x in held:
        x.end()
    print("resident MB", before, after)
    assert before - after > 50, (before, after)
