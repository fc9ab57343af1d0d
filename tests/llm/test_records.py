"""Archives and chat logs: exact round trips."""

import gzip
import hashlib
import os
import random
from collections import Counter

import pytest

from staywise.llm import chat, warc


def test_archive_round_trip(spark, tmp_path):
    rng = random.Random(2)
    parts = ["\r\n", "\r\n\r\n", "a", "é", "\r", "\n", "WARC/1.1\r\n"]
    rows = [(i, None if i % 7 == 0 else f"http://x/{i}\r\n é", "".join(rng.choices(parts, k=rng.choice([0, 1, 5, 900])))) for i in range(40)]
    rows += [(100, "u", rows[5][2] * 400), (99, "u", rows[5][2] * 400), (None, "u", rows[5][2] * 400), (101, None, None)]
    rows += [(7, "v", "z" * 999), (8, "v", "z" * 999)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path, chunk=500)
    got = warc.read_records(spark, path).collect()
    assert Counter((r.payload_bytes, r.payload_digest) for r in got) == Counter(
        (len((h or "").encode()), hashlib.sha1((h or "").encode()).hexdigest()) for _, _, h in rows
    )
    largest = {}
    for page, _, html in rows:
        if page is not None:
            largest[html or ""] = max(page, largest.get(html or "", page))
    want = Counter()
    for page, _, html in rows:
        to = largest.get(html or "") if len((html or "").encode()) >= 1000 else page
        want[(page, to if to != page else None)] += 1
    assert Counter((r.page_id, r.refers_to) for r in got) == want
    chunks = warc.read_archive(spark, path).where("record_type = 'response'").toPandas()
    assert chunks.chunk.map(lambda c: len(c or b"")).max() <= 500
    for _, part in chunks.groupby(["file", "record"], sort=False):
        data = b""
        for row in part.itertuples():
            data = row.chunk if row.chunk_no == 0 else data + row.chunk
            assert row.running_sha1 == hashlib.sha1(data or b"").hexdigest()
    warc.write_archive(pages.limit(0), path + "-none")
    assert warc.read_records(spark, path + "-none").count() == 0


@pytest.mark.parametrize("cut", [1, 5, 40, 600, 2500])
def test_cut_archives_raise(spark, tmp_path, cut):
    pages = spark.createDataFrame([(i, f"u{i}", chr(97 + i) * 3000) for i in range(3)], "page_id long, url string, html string").coalesce(1)
    path = str(tmp_path / "archive")
    warc.write_archive(pages, path, chunk=1000)
    (name,) = [f for f in os.listdir(path) if f.startswith("part-") and f.endswith(".gz")]
    with gzip.open(f"{path}/{name}") as whole:
        data = whole.read().rstrip(b"\r\n")
    (tmp_path / "cut").mkdir()
    with gzip.open(tmp_path / "cut" / "a.txt.gz", "wb") as out:
        out.write(data[:-cut])
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read_records(spark, str(tmp_path / "cut")).collect()
    # Between two segments of a record too.
    last = data.rindex(b"WARC/1.1")
    (tmp_path / "segment").mkdir()
    with gzip.open(tmp_path / "segment" / "a.txt.gz", "wb") as out:
        out.write(data[:last])
    with pytest.raises(Exception, match="ends inside a record"):
        warc.read_records(spark, str(tmp_path / "segment")).collect()


LOG = "conv_id long, seq long, message long, kind string, role string, text string, formatted string"


def test_log_is_folded(spark):
    rows = [
        (1, 1, 1, "message", "user", "Hi", ""),
        (1, 2, 2, "delta", "assistant", "Hel", ""),
        (1, 3, 2, "delta", None, "lo", ""),
        (1, 4, 2, "regenerate", "assistant", None, ""),
        (1, 6, 2, "delta", "assistant", "day", ""),
        (1, 5, 2, "delta", "assistant", "Good ", ""),
        (1, 7, 3, "message", "user", "old", ""),
        (1, 8, 3, "edit", "user", "new", ""),
        (2, 1, 1, "message", "user", "a", ""),
        (2, 2, 2, "message", "assistant", "b", ""),
        (2, 3, 1, "edit", "user", "c", ""),
        (3, 1, 1, "delta", "assistant", "gone", ""),
        (3, 2, 1, "regenerate", "assistant", None, ""),
        (None, 1, 1, "message", "us\ner", "<|im_end|> <<|| |>", ""),
    ]
    out = {r.conv_id: r for r in chat.format_chats(spark.createDataFrame(rows, LOG)).collect()}
    assert set(out) == {1, 2, None}
    text = out[1].formatted
    assert text == "<|im_start|>user\nHi<|im_end|>\n<|im_start|>assistant\nGood day<|im_end|>\n<|im_start|>user\nnew<|im_end|>\n"
    assert [text[s.start : s.end] for s in out[1].mask] == ["Good day"]
    assert out[2].formatted == "<|im_start|>user\nc<|im_end|>\n"


def test_hostile_texts_round_trip(spark):
    rng = random.Random(4)
    parts = ["<|im_end|>\n", "<|im_start|>", "<", "|", ">", "<||", "\n", "é", "x", "<|n|>"]
    rows = [(c, t, rng.choice(["user", "assistant", None, "a\nb", "<|"]), rng.choice([None, "".join(rng.choices(parts, k=9))])) for c in range(20) for t in range(5)]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    rendered = chat.format_chats(chat.log_of_turns(turns))
    out = rendered.select("conv_id", chat.turns_of(rendered.formatted).alias("t"), chat.learned_text(rendered.formatted, rendered.mask).alias("loss")).collect()
    for r in out:
        want = [(role or "", text or "") for c, _, role, text in rows if c == r.conv_id]
        assert [(t.role, t.text) for t in r.t] == want
        assert r.loss == "".join(text for role, text in want if role == "assistant")
    assert chat.format_chats(chat.log_of_turns(turns.limit(0))).count() == 0
