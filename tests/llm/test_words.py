"""Encoding, phrase mining and spelling variants against plain versions, with nulls, empty and long texts, repeats, ties and clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from staywise.llm import bpe, collocations, spelling

SCHEMA = "doc_id long, text string, lang string, id string, ids string, key string, word string, n string"


def table_of(spark, rows):
    return spark.createDataFrame([(d, t, lang, *"abcde") for d, t, lang in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(8)
    parts = [*"ab 1\n\t.é", "  ", "don't", "We'LL", "\x00", "\x01", "▁", "Ā", "日本", "🎉", "　", "'s", "<|endoftext|>", "퟿", "Straße", "x" * 40]
    rows = [(i, "".join(rng.choices(parts, k=rng.choice([1, 5, 60]))), "en") for i in range(120)]
    return [*rows, (200, None, "en"), (None, "", "en"), (201, "a" * 30_000 + " b" * 30_000 + " " * 5000, None), (5, rows[5][1], "en"), (5, "other", "en")]


def plain_encoding(path, pattern):
    import base64

    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("plain", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("name", ["byte_bpe_50k.tiktoken", "byte_bpe_multi_50k.tiktoken"])
def test_ids_are_those_of_the_rank_file(spark, texts, name):
    public = pytest.importorskip("public_tokenizers")
    vocabulary = bpe.Vocabulary.read(public.path(name), public.PATTERN)
    plain = plain_encoding(public.path(name), public.PATTERN)
    docs = table_of(spark, texts)
    encoded = bpe.encode(docs, vocabulary)
    assert Counter((r.id, tuple(r.ids)) for r in encoded.collect()) == Counter((d, tuple(plain.encode_ordinary(t or ""))) for d, t, _ in texts)
    assert Counter((r.id, bytes(r.decoded)) for r in bpe.decode(encoded, vocabulary).collect()) == Counter((d, (t or "").encode()) for d, t, _ in texts)
    got = Counter(tuple(r) for r in bpe.digests(docs, vocabulary).collect())
    want = Counter()
    for d, t, _ in texts:
        ids = plain.encode_ordinary(t or "")
        hexes = (hashlib.sha256(x).hexdigest() for x in (" ".join(map(str, ids)).encode(), (t or "").encode()))
        want[(d, len(ids), *hexes)] += 1
    assert got == want
    assert bpe.digests(docs.limit(0), vocabulary).count() == 0


def test_every_code_point_is_cut_and_encoded_alike():
    public = pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.tiktoken")
    codec, plain = bpe.Codec(bpe.Vocabulary.read(path, public.PATTERN)), plain_encoding(path, public.PATTERN)
    for first in range(0, 0x110000, 64):
        text = "".join(f"a{chr(c)}b {chr(c)}1{chr(c)}{chr(c)} x" for c in range(first, first + 64) if not 0xD800 <= c < 0xE000)
        assert codec.encode(text) == plain.encode_ordinary(text)
    with pytest.raises(ValueError, match="not in the vocabulary"):
        codec.decode([50_300])


def test_a_vocabulary_with_gaps_and_unreachable_tokens():
    ranks = {bytes([b]): 2 * b for b in range(256)} | {b"ab": 600, b"abc": 700, b"xyz": 800}
    codec = bpe.Codec(bpe.Vocabulary.of_ranks(ranks, r"\S+|\s+"))
    assert codec.encode("xyz abcab xyzx") == [800, 64, 700, 600, 64, 240, 242, 244, 240]
    data, ends = codec.decode(codec.encode("xyz abcab"))
    assert data.tobytes() == b"xyz abcab" and ends.tolist() == [3, 4, 7, 9]
    with pytest.raises(ValueError, match="without a rank"):
        bpe.Vocabulary.of_ranks({b"a": 0}, r"\S+")


def plain_collocations(rows, least, top):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lowered):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    inside = defaultdict(int)
    for (lang, words), a in f.items():
        for k in range(2, len(words)):
            for i in range(len(words) - k + 1):
                inside[lang, words[i : i + k]] = max(inside[lang, words[i : i + k]], a)
    found = defaultdict(list)
    for (lang, words), a in f.items():
        if len(words) < 2 or a < least or 100 * inside[lang, words] >= 80 * a:
            continue
        cuts = [(f[lang, words[:k]], f[lang, words[k:]]) for k in range(1, len(words))]
        score, k = min((2_000_000 * a // (left + right), k) for k, (left, right) in enumerate(cuts, 1))
        found[lang].append((-score, -a, " ".join(words).encode(), a, *cuts[k - 1], n[lang], score))
    return {
        (lang, rank, phrase.decode(), *rest)
        for lang, of_lang in found.items()
        for rank, (_, _, phrase, *rest) in enumerate(sorted(of_lang)[:top], 1)
    }


@pytest.mark.parametrize("budget", [1, 40, 1 << 20])
def test_phrases_match_a_plain_count(spark, budget):
    rng = random.Random(3)
    words = ["a", "B", "c\x00", "c\x00d", "\x01", "\x01\x02", "é", "New", "York", "a\x1f", "~"]
    ends = [" ", "  ", "\t", " ", " ", " ", ".", " \n ", ", "]
    rows = [(i, "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.choice([0, 1, 3, 80]))), rng.choice(["en", "de", None])) for i in range(150)]
    rows += [(900, None, "en"), (901, "   \n", "fr"), (902, "new york city " * 3000, "en"), (902, "new york city " * 3000, "en")]
    got = collocations.collocations(table_of(spark, rows), least=5, top=60, budget=budget)
    assert {tuple(r)[:8] for r in got.collect()} == plain_collocations(rows, 5, 60)
    assert collocations.collocations(table_of(spark, rows).limit(0)).count() == 0


def plain_variants(rows):
    n = Counter()
    for doc, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    n = {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out, form = {}, {}
    for w in n:
        others = [o for o in n if o != w and near(w, o)]
        best = min(others, key=lambda o: (-n[o], o), default=None)
        form[w] = best if best and n[best] >= 10 * n[w] else None
        out[w] = (form[w], n[w], len(others), n[form[w]] if form[w] else None)
    for w, rest in out.items():
        root = w
        while form[root]:
            root = form[root]
        out[w] = (w, rest[0], root, *rest[1:])
    return set(out.values())


@pytest.mark.parametrize("sample,cell", [(200_000, 4096), (200_000, 6), (60, 8)])
def test_variants_match_all_pairs(spark, sample, cell):
    rng = random.Random(5)
    stems = ["straßen", "letters", "settler", "Trestle", "aaaaaaaa", "différent", "ÉCOLES×", "q" * 200]
    words = []
    for stem in stems:
        words += [stem] * 4
        for _ in range(30):
            at = rng.randrange(len(stem))
            words.append(rng.choice([stem[:at] + stem[at + 1 :], stem[:at] + rng.choice("abcé") + stem[at:], stem[:at] + rng.choice("abzÉ") + stem[at + 1 :]]))
    rows = [(i, " ".join(rng.choices(words, k=60)) + "-" + " ".join(["chained"] * 5), "en") for i in range(40)]
    rows += [(300, "chainedd chainedd chaineddd chaineddd " + "chained " * 2500 + "chainedd " * 30, "en"), (None, "letters settler", None)]
    rows += [(301, None, "en"), (302, "", "en"), (303, "1234 !", "en"), (1, rows[1][1], "en")]
    got = spelling.variants(table_of(spark, rows), sample=sample, cell=cell).collect()
    assert {tuple(r) for r in got} == plain_variants(rows) and len(got) == len(set(got))
    assert any(r.form and r.form != r.root for r in got)
    assert spelling.variants(table_of(spark, rows).limit(0)).count() == 0


def test_distances_of_narrowed_counts_are_those_of_all_letters():
    """A cell's words use few letters; words asked may hold others, which count as they are."""
    cell, asked = ["abcabca", "abcabcb", "ccccccc"], ["abcabcé", "zzzabca", "éüabcab", "abcabca"]
    mine, theirs = spelling.letters(cell, 7)[1], spelling.letters(asked, 7)[1]
    used = mine.any(axis=0)
    few, others = spelling.narrowed(mine, used), spelling.narrowed(theirs, used)
    assert few.shape[1] == 4 and not few[:, -1].any()
    apart = lambda a, b: abs(a[:, None, :] - b[None, :, :]).sum(axis=2).tolist()
    assert apart(others, few) == apart(theirs, mine)
