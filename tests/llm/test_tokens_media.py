"""Exact round trips: tokens, packed blocks, sequences, FLAC."""

import collections
import hashlib
import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from assay.llm import bitpack, flac, media, packing, queries, tokens
from assay.llm.queries import vocabulary

TEXTS = [
    "Hello,  world!! It's 42 o'clock... naïve café ß ÀÉ", "", None, " \n\t", "ONRE!! OF!! the$$$ a&&& b|c", "don't 'S x's 're", "İstanbul K Å ﬁ é a b c\x1cd", "<|endoftext|> x<|startoftext|>y",
    "日本語 テキスト 123 １２", "word " * 9000, "x" * 20_000, "́ a", "A.b.c d-e_f", "emoji 🙂🙂 ok",
]


def reference(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary())
    t.encode_special_tokens = True
    return [t.encode(x or "", add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("limit", [10, 900_000])
def test_encoder_is_the_library(monkeypatch, limit):
    monkeypatch.setattr(tokens, "_MOST_WORDS", limit)
    e = tokens.Encoder(vocabulary())
    assert e.by_word
    for _ in range(2):
        assert [np.frombuffer(b, "<u4").tolist() for b in e.encode(TEXTS)] == reference(TEXTS)


def test_encoder_of_another_tokenizer():
    import public_tokenizers

    e = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    assert not e.by_word and e.encode([None, "a b"])[0] == b"" and len(e.encode(["a b"])[0]) == 8


def _without_lower_case(t):
    t["normalizer"] = {"type": "NFC"}


def _white_space_only(t):
    t["pre_tokenizer"] = {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}


def _spaces_kept(t):
    t["pre_tokenizer"] = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}


def _put_before(t):
    t["normalizer"] = {"type": "Sequence", "normalizers": [{"type": "Lowercase"}, {"type": "Prepend", "prepend": "x"}]}


@pytest.mark.parametrize("change,by_word", [(_without_lower_case, True), (_white_space_only, True), (_spaces_kept, False), (_put_before, False)])
def test_encoder_of_changed_tokenizers(tmp_path, change, by_word):
    """Cased, split at white space alone, white space kept, every text changed: the library's ids, by words only where words stand alone."""
    import json

    from tokenizers import Tokenizer

    t = json.load(open(vocabulary()))
    change(t)
    path = tmp_path / "changed.json"
    path.write_text(json.dumps(t))
    e, library = tokens.Encoder(str(path)), Tokenizer.from_file(str(path))
    library.encode_special_tokens = True
    texts = [*TEXTS, "The CAT don't.", "A-b, (C)D. E!f", "Straße, ÉCOLE; naïve"]
    assert e.by_word == by_word and not e.by_letters
    assert [np.frombuffer(b, "<u4").tolist() for b in e.encode(texts)] == [library.encode(x or "", add_special_tokens=False).ids for x in texts]


@pytest.mark.parametrize("bits", [1, 7, 8, 11, 16, 17, 24, 32])
def test_bit_packing(bits):
    ids = np.random.default_rng(bits).integers(0, 2**bits, 1000, dtype=np.uint64).astype(np.uint32)
    data = bitpack.pack(ids, bits)
    assert len(data) == math.ceil(1000 * bits / 8)
    for start, count in ((0, 1000), (0, 0), (1, 5), (333, 667), (999, 1)):
        assert (bitpack.unpack(data, bits, start, count) == ids[start : start + count]).all()
    assert [bitpack.bits_for(n) for n in (1, 2, 3, 49408, 65536, 65537)] == [1, 1, 2, 16, 16, 17]


def documents(spark):
    rows = [(7 * (len(TEXTS) - k), t, "x") for k, t in enumerate(TEXTS)] + [(7, "again", "y"), (None, "no id", "z")]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, start string").repartition(3)


def test_token_files(spark, tmp_path):
    rows, d = documents(spark)
    blocks = bitpack.write_tokens(d, vocabulary(), f"file://{tmp_path}/t", shards=4, block_ids=500)
    got = bitpack.read_tokens(blocks).collect()
    ordered = sorted(got, key=lambda r: r.start)
    assert [r.doc_id for r in ordered] == sorted((r[0] for r in rows), key=lambda x: (x is not None, x))
    at = 0
    for r in ordered:
        assert r.start == at and len(r.ids) == 4 * r.n_tokens and r.ids_crc32 == zlib.crc32(r.ids)
        at += r.n_tokens
    ids = {r[0]: i for r, i in zip(rows, reference([r[1] for r in rows])) if r[0] != 7}
    for r in ordered:
        if r.doc_id in ids:
            assert np.frombuffer(r.ids, "<u4").tolist() == ids[r.doc_id] + [2]
    want = collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in got if r.doc_id is not None)
    found = [bitpack.lookup(blocks, i).collect() for i in {r.doc_id for r in got if r.doc_id is not None}]
    assert collections.Counter((r.doc_id, r.n_tokens, r.ids_crc32, bytes(r.ids)) for f in found for r in f) == want
    assert bitpack.lookup(blocks, 15).count() == 0
    none = bitpack.write_tokens(d.limit(0), vocabulary(), f"file://{tmp_path}/e", shards=2)
    assert bitpack.read_tokens(none).count() == 0


def test_token_files_of_a_vocabulary_that_fills_no_bytes(spark, tmp_path):
    """Ids of 17 bits, most rows alike: every document comes back, by reading on and by looking up, and equal rows share out over shards."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    rows = [(k, f"some text {k} " * (k % 9)) for k in range(60)] + [(None, None)] * 400
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    blocks = bitpack.write_tokens(d, path, f"file://{tmp_path}/w", end_id=90_000, shards=8, block_ids=200)
    assert {r.bits for r in blocks.select("bits").collect()} == {17}
    assert blocks.where("first_id is null").select("shard").distinct().count() > 1
    e = tokens.Encoder(path)
    want = {k: np.frombuffer(e.encode([t])[0], "<u4").tolist() + [90_000] for k, t in rows if k is not None}
    got = bitpack.read_tokens(blocks).collect()
    assert len(got) == len(rows) and all(np.frombuffer(r.ids, "<u4").tolist() == want.get(r.doc_id, [90_000]) for r in got)
    assert all(np.frombuffer(bitpack.lookup(blocks, k).first().ids, "<u4").tolist() == want[k] for k in (0, 7, 59))


def test_packing_documents(spark):
    rows, d = documents(spark)
    out = packing.pack_documents(d, vocabulary(), capacity=1024, grain=8).collect()
    want = collections.Counter()
    for (doc, _, _), ids in zip(rows, reference([r[1] for r in rows])):
        ids = np.array([*ids, 1], "<u4")
        for p, lo in enumerate(range(0, len(ids), 1024)):
            part = ids[lo : lo + 1024].tobytes()
            want[doc, p, lo, len(part) // 4, zlib.crc32(part), part] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32, bytes(r.ids)) for r in out) == want
    check_sequences([(r.sequence_id, r.offset, r.length) for r in out], 1024)
    assert packing.pack_documents(d.limit(0), vocabulary()).count() == 0


def test_packing_by_a_plan_too_large_to_send(spark, monkeypatch):
    """The plan joined by spans of numbers gives the same packing; most pieces have one length."""
    rows = [(k, "word " * (5 if k % 3 else k % 50)) for k in range(400)]
    d = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = sorted(map(tuple, packing.pack_documents(d, vocabulary(), capacity=64, keep_ids=False).collect()))
    monkeypatch.setattr(packing, "_BROADCAST_ROWS", 0)
    assert sorted(map(tuple, packing.pack_documents(d, vocabulary(), capacity=64, keep_ids=False).collect())) == want


def check_sequences(placed, capacity):
    seqs = collections.defaultdict(list)
    for s, o, n in placed:
        seqs[s].append((o, n))
    for parts in seqs.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= capacity
    return len(seqs)


@pytest.mark.parametrize("seed", range(4))
def test_plans_hold_every_piece_and_are_tight(seed):
    rng = np.random.default_rng(seed)
    shape = [rng.integers(1, 4096, 3000), np.minimum(4096, rng.lognormal(6, 1, 5000).astype(int) + 1), np.array([1] * 5000 + [4096] * 3), np.full(2000, 2049)][seed]
    counts = collections.Counter(shape.tolist())
    groups = packing.plan_sequences(dict(counts))
    held = collections.Counter()
    for k, parts in groups:
        assert sum(n * m for n, m in parts) <= 4096
        for n, m in parts:
            held[n] += k * m
    assert held == counts
    bound = max(math.ceil(int(shape.sum()) / 4096), sum(c for n, c in counts.items() if n > 2048))
    assert sum(k for k, _ in groups) <= 1.02 * bound + 2
    assert packing.plan_sequences({}) == []


def test_fitted_repeats_solve_an_exact_mix():
    size, times = packing.patterns(16)
    assert ((size * times).sum(axis=1) == 16).all()
    truth = np.zeros(17)
    truth[[10, 6]] = 500
    truth[[8]] = 400
    x = packing.fit_repeats(size, times, truth)
    total = np.bincount(size.ravel(), (times * x[:, None]).ravel(), 17)
    assert (x >= 0).all() and np.abs(total[1:] - truth[1:]).max() < 5


# ---- FLAC


def payloads():
    rng = np.random.default_rng(4)
    b = flac.BLOCK
    return [
        b"\xff" * b, bytes(b), rng.integers(0, 256, 3 * b, dtype=np.uint8).tobytes(), (b"the cat sat on the mat. " * b)[: 20 * b], (np.sin(np.arange(9 * b) / 30) * 100 + 128).astype(np.uint8).tobytes(),
        np.where(rng.random(5 * b) < 0.01, 255, 128).astype(np.uint8).tobytes(), rng.integers(100, 104, 150 * b, dtype=np.uint8).tobytes(),
    ]


def test_flac_round_trip_and_plain_decoder():
    kinds: set[int] = set()
    for p, s, d in zip(payloads(), (streams := flac.encode(payloads())), flac.decode(streams)):
        assert (d.view(np.uint8) ^ 0x80).tobytes() == p
        info = flac.stream_info(s)
        assert info["samples"] == len(p) and [x[0] for x in info["seek"]] == list(range(0, len(p), flac.BLOCK * flac.SEEK_EVERY))
        at, got = info["first"], []
        while len(got) < len(p):
            if (len(got) // flac.BLOCK) % flac.SEEK_EVERY == 0:
                assert info["seek"][len(got) // flac.BLOCK // flac.SEEK_EVERY][1] == at - info["first"]
            number, block, head = flac._frame_head(s, at, len(s))
            assert number * flac.BLOCK == len(got)
            kinds.add(s[at + head] >> 1)
            part, at = flac.decode_frame(s, at, block, head, len(s))
            got += part
        assert got == d.tolist() and at == len(s)
    assert {0, 1, 8, 31 + flac._ORDER} <= kinds


class BitWriter:
    def __init__(self):
        self.bits = ""

    def put(self, v, n):
        self.bits += format(v & ((1 << n) - 1), f"0{n}b") if n else ""
        return self

    def rice(self, v, k):
        u = 2 * v if v >= 0 else -2 * v - 1
        self.bits += "0" * (u >> k) + "1"
        return self.put(u, k)

    def bytes(self):
        b = self.bits + "0" * (-len(self.bits) % 8)
        return int(b, 2).to_bytes(len(b) // 8, "big")


def frame(body, number=0):
    data = flac._header(number) + body
    crc = int(flac._crc16(np.frombuffer(data, np.uint8), np.array([0]), np.array([len(data)]))[0])
    return data + crc.to_bytes(2, "big")


def stream(samples, *frames):
    return flac._metadata((np.array(samples, np.int8).view(np.uint8) ^ 0x80).tobytes(), [len(f) for f in frames]) + b"".join(frames)


@pytest.mark.parametrize("kind", ["lpc", "escape", "parts", "fixed4", "wasted", "wide"])
def test_flac_kinds_of_other_encoders(kind):
    rng = random.Random(kind)
    s = [max(-128, min(127, int(60 * math.sin(k / 9)) + rng.randrange(-3, 4))) for k in range(flac.BLOCK)]
    w = BitWriter()
    if kind == "lpc":
        coefs, shift = [14, -7], 3
        w.put((32 + 1) << 1, 8).put(s[0], 8).put(s[1], 8).put(6 - 1, 4).put(shift, 5)
        for c in coefs:
            w.put(c, 6)
        w.put(0, 2).put(0, 4).put(3, 4)
        for k in range(2, len(s)):
            w.rice(s[k] - (sum(c * s[k - 1 - j] for j, c in enumerate(coefs)) >> shift), 3)
    elif kind == "fixed4":
        w.put((8 + 4) << 1, 8)
        for k in range(4):
            w.put(s[k], 8)
        w.put(0, 2).put(0, 4).put(5, 4)
        for k in range(4, len(s)):
            w.rice(s[k] - 4 * s[k - 1] + 6 * s[k - 2] - 4 * s[k - 3] + s[k - 4], 5)
    elif kind == "wasted":
        s = [2 * (v // 2) for v in s]
        w.put(8 << 1 | 1, 8).put(1, 1).put(0, 2).put(0, 4).put(4, 4)
        for v in s:
            w.rice(v // 2, 4)
    else:
        wide = 5 if kind == "wide" else 4
        w.put(8 << 1, 8).put(wide - 4, 2).put(2 if kind != "wide" else 0, 4)
        for p in range(4 if kind != "wide" else 1):
            part = s[p * 144 : p * 144 + 144] if kind != "wide" else s
            if kind == "escape" and p == 1:
                w.put(15, 4).put(8, 5)
                for v in part:
                    w.put(v, 8)
                continue
            k = 2 + p
            w.put(k, wide)
            for v in part:
                w.rice(v, k)
    data = stream(s, frame(w.bytes()))
    assert flac.decode([data, data])[1].tolist() == s


def test_flac_notices_damage():
    s = flac.encode([payloads()[3]])[0]
    for at in (flac.stream_info(s)["first"] + 40, len(s) - 1, 30):
        bad = bytearray(s)
        bad[at] ^= 0x10
        with pytest.raises(flac.FlacError):
            flac.decode([bytes(bad)])
    for cut in (3, 6, 30, 60, len(s) - 700, len(s) - 1):
        with pytest.raises(flac.FlacError):
            flac.decode([s[:cut]])
    rng = random.Random(6)
    for _ in range(60):
        bad = bytearray(s)
        for _ in range(rng.choice([1, 1, 40])):
            bad[rng.randrange(len(s))] ^= 1 << rng.randrange(8)
        try:
            assert flac.decode([bytes(bad)])[0].tolist() == flac.decode([s])[0].tolist()  # seek points and unused fields may differ
        except flac.FlacError:
            pass
    with pytest.raises(ValueError):
        flac.encode([b"abc"])


def hostile(number: int) -> list[bytes]:
    """Payloads whose frames hold what looks like the header of frame ``number``: as text, and among noise."""
    head = flac._header(number)
    rng = np.random.default_rng(3)
    noise = rng.integers(0, 256, 4 * flac.BLOCK, dtype=np.uint8)
    noise[100 : 100 + len(head)] = np.frombuffer(head, np.uint8) ^ 0x80
    noise[flac.BLOCK + 500 : flac.BLOCK + 500 + len(head)] = np.frombuffer(flac._header(2), np.uint8) ^ 0x80
    text = ("\x7fx \x814" + "aé" * 4000).encode()
    return [noise.tobytes(), media.pad(text), media.pad(b"\x7fx \x82" + noise.tobytes())]


def test_samples_that_look_like_a_header():
    for number in (1, 2, 3):
        p = hostile(number)
        streams = flac.encode(p)
        assert any(len(flac._likely_frames(s, flac.stream_info(s)["first"], len(s), flac.stream_info(s))) and s.count(b"\xff\xf8") > len(x) // flac.BLOCK for s, x in zip(streams, p))
        assert [(d.view(np.uint8) ^ 0x80).tobytes() for d in flac.decode(streams)] == p


def test_codes_without_end_are_errors():
    w = BitWriter().put(8 << 1, 8).put(0, 2).put(0, 4).put(3, 4)
    for tail in (b"", bytes(300_000)):
        with pytest.raises(flac.FlacError):
            flac.decode([stream([0] * flac.BLOCK, frame(w.bytes() + tail))])


def test_seeking_reads_the_same_samples():
    streams, whole = flac.encode(payloads() + hostile(1)), payloads() + hostile(1)
    rng = random.Random(8)
    for _ in range(6):
        at = [rng.randrange(-5, len(p) + 5) for p in whole]
        n = [rng.choice([0, 1, 40, 3000, 10**6]) for _ in whole]
        got = flac.read_samples(streams, at, n)
        assert [(g.view(np.uint8) ^ 0x80).tobytes() for g in got] == [p[max(0, a) : max(0, a) + k] for p, a, k in zip(whole, at, n)]


def test_media_of_hostile_and_very_long_texts(spark):
    texts = ["\x7fx \x814" + "aé" * 4000, "long é line " * 500_000, "\x7fx \x814" * 3000]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stored = media.encode_media(d, bytes_col="text")
    for r in media.describe_media(stored).collect():
        assert r.payload_sha256 == hashlib.sha256(media.pad(texts[r.id].encode())).hexdigest()
    tail = media.samples_at(stored, F.col("n_samples") if "n_samples" in stored.columns else 4_000_000, 7).collect()
    assert {r.id: (np.frombuffer(r.pcm, np.uint8) ^ 0x80).tobytes() for r in tail}[1] == media.pad(texts[1].encode())[4_000_000:4_000_007]


def test_media_query_reads_what_it_stored(spark):
    """The digests come from files that hold the streams, of every row, not from bytes on their way."""
    sf = "/root/testdata/sf0.001"
    out = queries.op5_media_columns(spark, sf)
    files = out.inputFiles()
    assert files and all("/media-" in f for f in files)
    stored = {r.id: hashlib.sha256(r.media).hexdigest() for r in spark.read.parquet(*files).collect()}
    assert stored == {r.doc_id: r.media_sha256 for r in out.collect()} and len(stored) == spark.read.parquet(f"{sf}/documents.parquet").count()


def test_media_column(spark):
    rows = [(1, "héllo", "a"), (2, None, "b"), (2, "", "c"), (None, "x" * 3000, "d"), (3, "héllo", "e")]
    d = spark.createDataFrame(rows, "doc_id long, text string, media string")
    stored = media.encode_media(d, bytes_col="text")
    got = {(r.id, r.n_bytes): r for r in media.describe_media(stored).collect()}
    assert len(got) == 4
    for key, text, _ in rows:
        b = (text or "").encode()
        r, p = got[key, len(b)], media.pad(b)
        assert (r.payload_bytes, r.payload_sha256, r.tail_crc32) == (len(p), hashlib.sha256(p).hexdigest(), zlib.crc32(p[-32:]))
    assert got[1, 6].media_sha256 == got[3, 6].media_sha256 and got[1, 6].feature == got[3, 6].feature
    blocks = media.pcm_blocks(stored.where("id is null"), 1000).orderBy("sample_offset").collect()
    assert [r.sample_offset for r in blocks] == [0, 1000, 2000, 3000] and sum(r.n_samples for r in blocks) == 3456
    assert (np.frombuffer(b"".join(r.pcm for r in blocks), np.uint8) ^ 0x80).tobytes() == media.pad(b"x" * 3000)
    assert media.describe_media(media.encode_media(d.limit(0), bytes_col="text")).count() == 0
    assert d.select(F.lit(1)).count() == 5


def test_long_payloads_are_coded_and_read_in_runs(spark, monkeypatch):
    """The same stream and digests however many frames are held at a time; a broken long stream is found out."""
    rng = np.random.default_rng(4)
    texts = [b"", b"a" * 5000, rng.integers(0, 256, 576 * 150 + 9, dtype=np.uint8).tobytes(), b"some words again and again " * 9000]
    payloads = [media.pad(t) for t in texts]
    want = flac.encode(payloads)
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, payload binary").coalesce(1)
    whole = sorted(map(tuple, media.describe_media(media.encode_media(rows)).collect()))
    monkeypatch.setattr(flac, "RUN", 40)
    monkeypatch.setattr(media, "_AT_ONCE", 20_000)
    assert flac.encode(payloads) == want
    for stream, payload in zip(want, payloads):
        runs = list(flac.decode_runs(stream))
        assert b"".join((r.view(np.uint8) ^ 0x80).tobytes() for r in runs) == payload and all(len(r) <= 576 * 56 for r in runs)
    batches = spark.createDataFrame([(k, s, len(t)) for k, (s, t) in enumerate(zip(want, texts))], "id long, media binary, n_bytes long").select("id", "n_bytes", "media").toArrow().to_batches()
    assert sorted(tuple(r.values()) for b in media._describe(iter(batches)) for r in b.to_pylist()) == whole
    pcm = [(r["id"], r["sample_offset"], r["pcm"]) for b in media._blocks(iter(batches), 1000) for r in b.to_pylist()]
    for k, payload in enumerate(payloads):
        mine = [(at, data) for i, at, data in pcm if i == k]
        assert [at for at, _ in mine] == list(range(0, len(payload), 1000)) and b"".join(d for _, d in mine) == (np.frombuffer(payload, np.uint8) ^ 0x80).tobytes()
    broken = bytearray(want[3])
    broken[len(broken) // 2] ^= 1
    with pytest.raises(flac.FlacError):
        list(flac.decode_runs(bytes(broken)))
