"""Each operator against brute force, on odd rows, on empty tables and on the smallest test tables."""

import base64
import hashlib
import random
import re
import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from compare import connect, normal, rows
from odd_rows import prose
from pyspark.sql import functions as F

from tidewright.llm import elias_fano, language_id, mpeg_audio, packing, quality_rules, queries, sentencepiece_viterbi, simhash, toxicity, url_rules, warc
from tidewright.llm.components import components
from tidewright.llm.oracles import ORACLE_SQL

BPE, PIECES = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")


def texts_of(df):
    return Counter((r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect())


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_sql(spark, sf, name):
    df = queries.QUERIES[name](spark, sf)
    found = connect(sf).execute(ORACLE_SQL[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == sorted(df.columns)
    assert normal(rows(df.columns, df.collect())) == normal(rows(names, found.fetchall()))


# 1 MPEG audio


def check_media(df):
    want = defaultdict(list)
    for (doc_id, text), n in texts_of(df).items():
        data = text.encode()
        padded = data + b"\xff" * (-len(data) % 576 or (0 if data else 576))
        want[doc_id] += [(len(data), len(padded), hashlib.sha256(padded).hexdigest(), zlib.crc32(padded[-32:]))] * n
    got = defaultdict(list)
    for r in mpeg_audio.audio_round_trip(df).collect():
        got[r.doc_id].append((r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32))
        assert r.n_frames * 576 == r.payload_bytes and r.duration_us == r.n_frames * 36_000 and r.crc_wrong == 0 == r.resyncs
        assert len(r.seek_offsets) == r.n_frames and '"table_ok": true' in r.feature and '"payload_ok": true' in r.feature
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_media(docs, odd, empty):
    check_media(docs)
    check_media(odd)
    assert mpeg_audio.audio_round_trip(empty).count() == 0


def test_media_reader_finds_frames_again():
    data = random.Random(1).randbytes(576 * 20).replace(b"\xff", b"\x00")
    stream = bytearray(mpeg_audio.write_stream(data))
    whole = mpeg_audio.read_stream(bytes(stream))
    assert mpeg_audio.read_payload(bytes(stream)) == data and whole.table == "Xing" and whole.id3v1
    cut = whole.offsets[3]
    damaged = bytes(stream[:cut]) + b"junk" * 50 + bytes(stream[cut:])
    again = mpeg_audio.read_stream(damaged)
    assert (again.resyncs, again.skipped, len(again.offsets)) == (1, 200, 20)
    stream[whole.offsets[5] + 8] ^= 1
    assert mpeg_audio.read_stream(bytes(stream)).crc_wrong == 1
    assert mpeg_audio.read_stream(bytes(stream)[: whole.offsets[-1] + 9]).truncated == 1
    assert not mpeg_audio.read_stream(b"no audio at all").offsets


def test_media_headers_of_other_kinds():
    h = mpeg_audio.read_header(bytes((0xFF, 0xFB, 0x90, 0x00)))
    assert (h.version, h.layer, h.kbps, h.sample_rate, h.samples, h.length, h.side) == (3, 3, 128, 44100, 1152, 417, 32)
    assert mpeg_audio.read_header(bytes((0xFF, 0xFF, 0x10, 0xC4))).layer == 1
    assert mpeg_audio.read_header(b"\xff\xff\xff\xff") is None
    assert mpeg_audio.crc16(b"123456789") == 0xAEE7  # the published check value of this CRC


def test_media_checksums_of_other_layers():
    """Frames of Layers I and II whose checksums are computed here bit by bit, over allocations and, in Layer II, selections."""

    def bits_crc(bits):
        crc = 0xFFFF
        for bit in bits:
            top = crc >> 15 ^ bit
            crc = (crc << 1 & 0xFFFF) ^ (0x8005 if top else 0)
        return crc

    as_bits = lambda data: [b >> k & 1 for b in data for k in range(7, -1, -1)]
    rng = random.Random(4)
    for word, expected in (
        (bytes((0xFF, 0xFE, 0x90, 0xC0)), lambda bits: 4 * 32),  # Layer I, mono
        (bytes((0xFF, 0xFE, 0x90, 0x00)), lambda bits: 4 * 64),  # Layer I, stereo
        (bytes((0xFF, 0xFE, 0x90, 0x50)), lambda bits: 4 * (8 + 8 + 24)),  # Layer I, joint from subband 8 on
        (bytes((0xFF, 0xFC, 0x44, 0xC0)), None),  # Layer II, mono, 56 kbit/s at 48 kHz: 27 subbands
    ):
        h = mpeg_audio.read_header(word)
        assert h.protected and h.layer == 4 - (word[1] >> 1 & 3)
        body = bytearray(rng.randbytes(h.length - 6))
        bits = as_bits(body)
        if expected:
            n = expected(bits)
        else:
            n = used = 0
            for width in [4] * 11 + [3] * 12 + [2] * 4:
                used += any(bits[n : n + width])
                n += width
            n += 2 * used
        crc = bits_crc(as_bits(word[2:4]) + bits[:n])
        frame = word + crc.to_bytes(2, "big") + bytes(body)
        good = mpeg_audio.read_stream(frame * 3)
        assert (good.crc_checked, good.crc_wrong) == (3, 0)
        body[0] ^= 0x80
        assert mpeg_audio.read_stream(frame + word + crc.to_bytes(2, "big") + bytes(body)).crc_wrong == 1


def test_media_tags_and_tables_of_other_encoders():
    def frame22(name, text):
        body = b"\x00" + text
        return name + len(body).to_bytes(3, "big") + body

    tags = frame22(b"TT2", b"a title") + frame22(b"TXX", b"key\x00value")
    assert mpeg_audio.read_stream(b"ID3\x02\x00\x00" + mpeg_audio._syncsafe(len(tags)) + tags).tags == {"TT2": "a title", "TXXX:key": "value"}
    inner = mpeg_audio._text_frame(b"TIT2", "song")
    for version, extended in ((3, (6).to_bytes(4, "big") + bytes(6)), (4, mpeg_audio._syncsafe(6) + bytes(2))):
        block = extended + inner
        assert mpeg_audio.read_stream(b"ID3" + bytes((version, 0, 0x40)) + mpeg_audio._syncsafe(len(block)) + block).tags == {"TIT2": "song"}
    word = bytes((0xFF, 0xFB, 0x90, 0x00))
    plain = word.ljust(417, b"\0")
    vbri = (word + bytes(32) + b"VBRI" + bytes((0, 1, 2, 0x40, 0, 75)) + struct.pack(">IIHHHH", 1668, 3, 3, 1, 2, 1) + struct.pack(">HHH", 417, 417, 417)).ljust(417, b"\0")
    s = mpeg_audio.read_stream(vbri + plain * 3)
    assert (s.table, s.table_frames, s.table_bytes, s.delay, s.seek_table) == ("VBRI", 3, 1668, 0x240, [834, 1251, 1668])
    info = (word + bytes(32) + b"Info" + struct.pack(">III", 3, 3, 1668) + b"LAME3.100" + bytes(12) + bytes((0x24, 0x03, 0x84))).ljust(417, b"\0")
    s = mpeg_audio.read_stream(info + plain * 3)
    assert (s.delay, s.padding, s.audible) == (576, 900, 3 * 1152 - 576 - 900)


# 2 SentencePiece


def test_pieces_agree_with_the_library(docs, tmp_path):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    with open(PIECES, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1  # unigram; the library adds in 32 bits, so huge scores would hide the others
    for p in proto.pieces:
        p.score = max(p.score, -5000.0)
    path = str(tmp_path / "unigram.model")
    with open(path, "wb") as f:
        f.write(proto.SerializeToString())
    library, own, given = sentencepiece.SentencePieceProcessor(model_file=path), sentencepiece_viterbi.Pieces.load(path), sentencepiece_viterbi.Pieces.load(PIECES)
    for t in [r.text for r in docs.limit(60).collect()] + ["", "  a  ", "你好\n𝔸b 🙂", "www.example.com a.b,c!!"]:
        for part in (t[i : i + 150] for i in range(0, min(len(t), 900) or 1, 150)):
            assert own.encode(part) == library.encode(part)
            ids = given.encode(part)
            assert ids == list(given.viterbi(given.normalise(part))) and given.decode(ids) == part


def test_viterbi_by_brute_force():
    pieces = sentencepiece_viterbi.Pieces([("<unk>", 0.0, "unknown"), ("▁", -3.0, "normal"), ("a", -2.0, "normal"), ("b", -2.5, "normal"), ("ab", -3.1, "normal"), ("ba", -4.6, "normal"), ("aba", -6.0, "normal"), ("▁a", -4.0, "normal")])
    score = {p: s for p, s, k in pieces.pieces if k == "normal"}

    def best(t):
        if not t:
            return 0.0
        ways = [score[t[:k]] + best(t[k:]) for k in range(1, 4) if t[:k] in score]
        return max(ways + ([pieces.fallback_score + best(t[1:])] if t[0] not in score else []))

    rng = random.Random(3)
    for _ in range(200):
        t = "".join(rng.choice("ab▁c") for _ in range(rng.randint(0, 9)))
        ids = pieces.viterbi(t)
        if "cc" not in t:
            assert abs(sum(pieces.fallback_score if i == 0 else pieces.pieces[i][1] for i in ids) - best(t)) < 1e-9


def test_pieces_on_odd_rows(odd, empty):
    encoded = sentencepiece_viterbi.encode(odd, PIECES)
    back = Counter((r.doc_id, r.text) for r in sentencepiece_viterbi.decode(encoded, PIECES).collect())
    assert back == texts_of(odd)
    assert sentencepiece_viterbi.encode_digests(empty, PIECES).count() == 0


# 3 Elias-Fano


def test_elias_fano_is_small_and_selects():
    for n, top in ((0, 0), (1, 0), (5, 3), (1000, 50), (1000, 5_000_000)):
        values = np.sort(np.random.default_rng(n).integers(0, top + 1, n))
        ef, _ = elias_fano.EliasFano.from_bytes(elias_fano.EliasFano.build(values).to_bytes())
        assert list(ef.values()) == values.tolist() == [ef.select(i) for i in range(n)]
    assert (len(ef.low) + len(ef.high) + 8 * len(ef.samples)) * 8 / 1000 < 3.1 + np.log2(5000)
    with pytest.raises(IndexError):
        ef.select(1000)


def check_tokens(spark, df, block_ids):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    want = sorted(((-(1 << 63) if d is None else d), text) for (d, text), n in texts_of(df).items() for _ in range(n))
    start, expected = 0, []
    for d, text in want:
        ids = np.array([*t.encode(text, add_special_tokens=False).ids, 1], "<u4")
        expected.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    blocks = elias_fano.write_blocks(df, BPE, 1, block_ids)
    found = elias_fano.read_documents(blocks).collect()
    assert sorted(((-(1 << 63) if r.doc_id is None else r.doc_id), r.start, r.n_tokens, r.ids_crc32) for r in found) == sorted(expected)


def test_token_blocks(spark, docs, odd, empty):
    check_tokens(spark, docs, 10_000)
    check_tokens(spark, odd, 100)
    assert elias_fano.read_documents(elias_fano.write_blocks(empty, BPE, 1)).count() == 0


def test_block_gives_single_documents():
    b = elias_fano.Block(elias_fano.write_block([None, -3, 70_000], [2, 0, 1], np.array([5, 1, 70_000], "<u4")))
    assert [b.doc_id(i) for i in range(3)] == [None, -3, 70_000] == [d for d, _, _ in b.documents()] and b.document(0).tolist() == [5, 1] and b.document(1).tolist() == [] and b.document(2).tolist() == [70_000]


def test_words_give_the_library_s_ids(docs):
    e = elias_fano.WordEncoder(BPE)
    t = [r.text for r in docs.collect()] + ["", "  a  ", "É́", "éÉ.,# İ", "<|endoftext|> a", "it's, DON'T!!", "a\x1cb", "ſt ǅ ΑΣ, ΑΣ", "a" * 200 + " " + "中" * 300]
    assert e.by_word and [x.tobytes() for x in e.encode(t)] == e._plain(t)


# 4 quality rules


def test_measurements(odd, docs, empty):
    def brute(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
        often = Counter(grams)
        marked = {p for i, g in enumerate(grams) if often[g] > 1 for p in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(marked)

    for df in (odd, docs):
        want = Counter((d, *brute(t)) for (d, t), n in texts_of(df).items() for _ in range(n))
        got = quality_rules.verdicts(df).collect()
        assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
        assert all(r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and (not r.kept or not r.base_failed) for r in got)
    assert quality_rules.verdicts(empty).count() == 0


def test_policies_and_ablations(docs):
    entries = quality_rules.ledger(docs).cache()
    policy = quality_rules.POLICIES["strict"]
    found = {r.rule: r for r in quality_rules.ablations(entries, policy).collect()}
    bits = [r.failed for r in entries.collect()]
    for i, rule in enumerate(quality_rules.RULES):
        rest = quality_rules.mask(policy) & ~(1 << i)
        assert (found[rule.name].failing, found[rule.name].kept_without) == (sum(b >> i & 1 for b in bits), sum(b & rest == 0 for b in bits))


def test_kept_documents_have_all_columns(odd, empty):
    kept = quality_rules.keep_passing(odd)
    assert kept.columns == odd.columns and {r.doc_id for r in kept.collect()} == {None, 4, 5, 6, -11}
    assert quality_rules.keep_passing(empty).count() == 0


# 5 URL rules


def test_urls(spark):
    urls = {
        "https://www.EXAMPLE.com/en/x?y": ("www.example.com", "/en/x", "www.example.com/en/", "allow"), "http://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "http://notexample.com/en/": ("notexample.com", "/en/", "com/", "allow"), "http://example.com": ("example.com", "", None, "allow"), "http://x.net/es/1": ("x.net", "/es/1", "net/es/", "block"),
        "http://spam-farm.example.org/x": ("spam-farm.example.org", "/x", None, "block"), "http://a.org/spam-farm.": ("a.org", "/spam-farm.", None, "allow"), "no scheme": ("", "", None, "allow"),
        None: ("", "", None, "allow"), "http://spam-farm.example.com/en/": ("spam-farm.example.com", "/en/", "example.com/en/", "block"), "x://h?a://b/c": ("h", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "extra") for i, u in enumerate(urls)] + [(None, None, None)], "page_id long, url string, host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge(pages).collect()}
    assert got == dict(enumerate(urls.values())) | {None: ("", "", None, "allow")}
    assert url_rules.judge(pages.limit(0)).count() == 0
    long = "http://a.org/" + "-".join(f"t{i}" for i in range(20_000)) + "/casino-x"
    assert [r.verdict for r in url_rules.judge(spark.createDataFrame([(1, long), (2, "http://casino.org/" + "y" * 100_000)], "page_id long, url string")).orderBy("page_id").collect()] == ["allow", "block"]


def test_thousands_of_rules_by_brute_force(spark):
    rng = random.Random(12)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in ("l", "n", "rt", "st", "x")]
    rules = []
    for i in range(5000):
        first, second = rng.sample(words, 2)
        shape = rng.choice([rf"://([^/?#]*[.-])?{first}-{second}\.", rf"/{first}/[^?#]*{second}[0-9]+\b", rf"[?&]{first}={second}(&|$)"])
        rules.append((f"r{i:04}", shape, [first] if "0-9" in shape else [first, second]))
    table = spark.createDataFrame(rules, "name string, pattern string, tokens array<string>")
    urls = [f"http://{rng.choice(words)}-{rng.choice(words)}.org/{rng.choice(words)}/{rng.choice(words)}{rng.choice(['', '7', '/42'])}?{rng.choice(words)}={rng.choice(words)}" for _ in range(400)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in url_rules.judge(pages, (), url_rules.pattern_rules(table)).collect()}
    compiled = [(name, re.compile(pattern)) for name, pattern, _ in rules]
    for i, u in enumerate(urls):
        assert sorted(got[i].hits) == [name for name, p in compiled if p.search(u)] and got[i].n_candidates < 1500
    assert any(r.hits for r in got.values())
    with pytest.raises(ValueError):
        url_rules.pattern_rules(spark.createDataFrame([("x", "y", [])], "name string, pattern string, tokens array<string>"))


def test_rules_are_filed_under_their_rarest_token():
    index = url_rules.index_rules(url_rules.PATTERN_RULES[:2], {"spam": 9, "farm": 2, "cheap": 0, "pills": 5})
    assert {k: [r.name for r in v] for k, v in index.items()} == {"farm": ["spam farms"], "cheap": ["pill shops"]}


# 6 packing


def check_bins(df, capacity=50, per_source=2):
    length = F.size(F.array_remove(F.split("text", r"[\x20\x09-\x0D]+"), "")).cast("long") + 1
    found = packing.pack(df, capacity=capacity, per_source=per_source, group=8).collect()
    want = Counter((d, len(re.findall(r"[^\x20\x09-\x0D]+", t)) + 1) for (d, t), n in texts_of(df).items() for _ in range(n))
    total = defaultdict(int)
    for (d, n), k in want.items():
        total[d] += n * k
    got, bins = defaultdict(int), defaultdict(list)
    for r in found:
        got[r.doc_id] += r.n_tokens
        bins[r.bin].append((r.bin_offset, r.n_tokens))
    assert got == total
    for pieces in bins.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= capacity
    return found, length


def test_bins(docs, odd, empty):
    check_bins(odd)
    check_bins(docs, 500)
    assert packing.pack(empty).count() == 0


def test_lengths_are_tokens_and_bins_are_full(spark, docs, odd, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(BPE)
    for df in (odd, docs):
        want = Counter()
        for (d, text), n in texts_of(df).items():
            want[d] += n * (len(t.encode(text, add_special_tokens=False).ids) + 1)
        got = Counter()
        for r in packing.pack(df, tokenizer=BPE).collect():
            got[r.doc_id] += r.n_tokens
        assert got == want
    assert packing.pack(empty, tokenizer=BPE).count() == 0
    large = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    for table in (large, large.withColumn("source", F.lit("one"))):
        assert packing.fill(packing.pack(table)).first()["fill"] > 0.96
    same = spark.range(9000).select(F.lit(1).alias("doc_id"), F.lit("a b").alias("text"), F.lit(None).cast("string").alias("source"))
    bins = packing.pack(same, group=1000).groupBy("bin").count()
    assert bins.count() == 9000  # copies never share a bin
    assert bins.select(F.split("bin", "-")[0]).distinct().count() > 5  # and rows that repeat don't meet in one group


def test_best_fit_by_brute_force():
    rng = random.Random(5)
    packer = packing.Packer(100, 2)
    bins = []  # (left, number, clusters, sources)
    for _ in range(400):
        n, source, cluster = rng.randint(1, 60), rng.choice("aabc"), rng.randint(0, 60)
        fits = [b for b in bins if b[0] >= n and cluster not in b[2] and b[3][source] < 2]
        if fits:
            b = min(fits, key=lambda b: (b[0], b[1]))
        else:
            bins.append(b := [100, len(bins), set(), Counter()])
        want = (b[1], 100 - b[0])
        b[0] -= n
        b[2].add(cluster)
        b[3][source] += 1
        assert packer.place(n, source, cluster) == want


# 7 toxicity


def test_toxicity(spark, odd, empty):
    rng = random.Random(2)
    rows = []
    for i in range(600):
        toxic = int(i % 4 == 0)
        sentences = [" ".join(f"w{rng.randint(0, 300)}" for _ in range(8)) for _ in range(5)]
        if toxic:
            sentences[rng.randrange(5)] += " " + rng.choice(["vile", "foul"])
        rows.append((i, ". ".join(sentences), toxic))
    table = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.fit_model(table, table.select("doc_id", "toxic"))
    found = toxicity.score(table, model).collect()
    truth = {i: y for i, _, y in rows}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in found)
    assert sum(r.predicted == truth[r.doc_id] for r in found if r.held_out) >= 0.95 * sum(r.held_out for r in found)
    hits = toxicity.locate(table, model).collect()
    assert hits and all("vile" in h.sentence or "foul" in h.sentence for h in hits)
    text = {i: t for i, t, _ in rows}
    worst = [r for r in found if r.worst_start is not None]
    assert worst and all(any(w in text[r.doc_id][r.worst_start : r.worst_end] for w in ("vile", "foul")) and r.n_offending >= 1 for r in worst)
    twice = spark.createDataFrame([(1, "vile words", "x"), (1, "vile words", "y"), (2, "vile words", None)], "doc_id long, text string, score string")
    assert len({(r.score, r.predicted, r.worst_start) for r in toxicity.score(twice, model).collect()}) == 1  # ties
    assert toxicity.score(odd, model).count() == odd.count() and toxicity.score(empty, model).count() == 0
    none = toxicity.fit_model(table, table.select("doc_id", F.lit(None).cast("int").alias("toxic")))
    assert none.constant == 0.0 and toxicity.fit_model(empty.select("doc_id", "text"), table.select("doc_id", "toxic")).constant == 0.0


def test_noisy_or_gradient_by_differences():
    rng = np.random.default_rng(3)
    doc, y = np.sort(rng.integers(0, 6, 20)), np.array([0.0, 1, 0, 1, 1, 0])
    doc[:6] = range(6)
    z = rng.normal(0, 2, 20)

    def likelihood(z):
        total = 0.0
        for d in range(6):
            clean = np.prod([1 - 1 / (1 + np.exp(-z[i])) for i in range(20) if doc[i] == d])
            total += toxicity.TOXIC_WEIGHT * np.log(1 - clean) if y[d] else np.log(clean)
        return total

    value, push = toxicity.noisy_or_gradient(z, doc, y)
    assert value == pytest.approx(likelihood(z))
    for i in range(20):
        step = np.eye(20)[i] * 1e-6
        assert push[i] == pytest.approx((likelihood(z + step) - likelihood(z - step)) / 2e-6, abs=1e-5)


def test_toxicity_query_by_brute_force(spark):
    """The query's scores, a sentence and a word at a time from the model's weights; held-out documents are found."""
    where = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{where}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit_model(docs, labels)
    found = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    for r in docs.where("doc_id % 50 = 0").collect():
        clean = 1.0
        for sentence in re.findall(r"[^.!?\n]+", (r.text or "").lower()) or [""]:
            words = set(re.findall(r"[^\W\d_]+", sentence))
            clean *= 1 - sigmoid(model.bias + sum(model.weights.get(f, 0) for w in words for f in toxicity.features(w)))
        assert found[r.doc_id].score == pytest.approx((1 - clean) ** (np.log(0.5) / np.log(toxicity.CUT)), abs=1e-6)
    judged = [(r.toxic, found[r.doc_id]) for r in labels.collect() if r.toxic is not None and r.doc_id in found and found[r.doc_id].held_out]
    toxic = [r for y, r in judged if y]
    assert sum(r.predicted for r in toxic) >= 0.88 * len(toxic) and sum(r.predicted for y, r in judged if not y) <= 0.005 * len(judged)
    assert all(r.predicted == (r.score >= 0.5) and r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found.values())


def test_noisy_or_is_that_of_the_sentences():
    model = toxicity.Model(-2.0, {"bad$": 3.0})
    p = [model.sentence(s) for s in ("so bad", " really ", " bad bad")]
    assert model.document("So bad. Really ! bad BAD") == pytest.approx(1 - np.prod([1 - x for x in p]))


# 8 SimHash


def brute_components(df, size=3, radius=2):
    import xxhash

    def fp(t):
        w = t.encode().lower().split()
        grams = [b" ".join(w[i : i + size]) for i in range(max(1, len(w) - size + 1))] if w else []
        hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)) if hashes else 0

    docs = [(d, fp(t)) for (d, t), n in texts_of(df).items() for _ in range(n)]
    union = simhash.Union(len(docs))
    for i in range(len(docs)):
        for j in range(i):
            if (docs[i][1] ^ docs[j][1]).bit_count() <= radius:
                union.join(i, j)
    least = {}
    for i, (d, _) in enumerate(docs):
        if d is not None:
            least[union.root(i)] = min(d, least.get(union.root(i), d))
    return Counter((d, f"{f:016x}", least.get(union.root(i))) for i, (d, f) in enumerate(docs))


def test_components(docs, odd, empty):
    for df in (docs, odd):
        assert Counter(tuple(r) for r in simhash.link_components(df).collect()) == brute_components(df)
    assert simhash.link_components(empty).count() == 0


def test_hot_shards_are_dealt_again(spark):
    rng = random.Random(8)
    centre = rng.getrandbits(64)
    values = sorted({centre ^ sum(1 << rng.randrange(12) for _ in range(rng.randint(0, 3))) for _ in range(300)} | {rng.getrandbits(64) for _ in range(300)})
    points = spark.createDataFrame([(0, simhash._signed(v), None) for v in values], "seed int, fp long, node long")
    union = simhash.Union(len(values))
    place = {v: i for i, v in enumerate(values)}
    for r in simhash.shards(points, 2, most=20).collect():
        fps = [p.fp for p in r.points]
        for i, j in simhash.linked_pairs(fps, 2):
            assert ((fps[i] ^ fps[j]) & simhash._ALL).bit_count() <= 2
            union.join(place[fps[i] & simhash._ALL], place[fps[j] & simhash._ALL])
    want = simhash.Union(len(values))
    for i in range(len(values)):
        for j in range(i):
            if (values[i] ^ values[j]).bit_count() <= 2:
                want.join(i, j)
    assert [union.root(i) for i in range(len(values))] == [want.root(i) for i in range(len(values))]


def test_bk_tree():
    rng = random.Random(4)
    values = [rng.getrandbits(16) for _ in range(400)]
    tree = simhash.BKTree()
    places = [tree.add(v) for v in values]
    assert [tree.values[p] for p in places] == values
    for v in values[:50]:
        assert {tree.values[i] for i in tree.within(v, 3)} == {x for x in values if (x ^ v).bit_count() <= 3}


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(100)] + [(500, 400), (400, 500), (7, 7)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(101)} | {400: 400, 500: 400}


def test_one_of_each_group_stays(spark, odd, empty):
    base = prose(20, 200).split()
    near = base[:100] + ["edit"] + base[101:]
    far = base[:100] + prose(21, 100).split()
    rows = [(5, " ".join(base), "x"), (3, " ".join(near), "y"), (9, " ".join(base).upper(), "z"), (11, " ".join(far), "x"), (11, " ".join(far), "x"), (12, prose(22, 50), None)]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, place string"))
    assert kept.columns == ["doc_id", "text", "place"]
    assert sorted(r.doc_id for r in kept.collect()) == [3, 11, 12]
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in simhash.keep_one(odd).collect())
    assert [d for null, d in ids if not null] == [-11, 1, 4, 6, 7, 8, 9, 10] and sum(null for null, _ in ids) == 1
    assert simhash.keep_one(empty).count() == 0


def test_near_copies_that_differ_by_a_passage_are_found(spark):
    rng = random.Random(31)
    words = [f"w{i}" for i in range(4000)]
    text = lambda n: [rng.choice(words) for _ in range(n)]
    boilerplate = text(40)
    rows = []
    for n in (80, 150, 269, 700) * 15:
        base = text(n) + boilerplate
        n += 40
        at = rng.randrange(n // 2)
        part = int(n * rng.uniform(0.02, 0.25))
        rows += [base, base + text(part), base[: n - part], base[:at] + text(part // 2) + base[at + part // 2 :], text(20) + boilerplate]
    docs = [(i, " ".join(t)) for i, t in enumerate(rows)]
    sets = [simhash.shingle_set(t) for _, t in docs]
    union = simhash.Union(len(docs))
    for i, mine in enumerate(sets):
        for j in range(i):
            common = len(np.intersect1d(mine, sets[j]))
            if common >= 0.8 * (len(mine) + len(sets[j]) - common):
                union.join(i, j)
    kept = simhash.keep_one(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    assert sorted(r.doc_id for r in kept.collect()) == [i for i in range(len(docs)) if union.root(i) == i]


def groups_by_brute_force(texts):
    """The places of texts with the least place of their component, by whole shingle sets; and the similarity of each pair of 0.8 or more."""
    sets = [simhash.shingle_set(t) for t in texts]
    union, found = simhash.Union(len(texts)), {}
    order = sorted(range(len(sets)), key=lambda i: len(sets[i]))
    holders = defaultdict(list)
    for i in order:
        common = Counter(j for x in sets[i].tolist() for j in holders[x])
        for j, c in common.items():
            jaccard = c / (len(sets[i]) + len(sets[j]) - c)
            if jaccard >= 0.8:
                found[min(i, j), max(i, j)] = jaccard
                union.join(i, j)
        for x in sets[i].tolist():
            holders[x].append(i)
    return [union.root(i) for i in range(len(texts))], found


@pytest.mark.parametrize("where", ["sf0.001", "sf0.01"])
def test_near_copies_of_the_tables_by_similarity(spark, where):
    df = spark.read.parquet(f"/root/testdata/{where}/documents.parquet")
    classes = {r["class"].hex(): (r["doc_id"], r.text) for r in df.groupBy(simhash.class_of().alias("class")).agg(F.min("doc_id").alias("doc_id"), F.max("text").alias("text")).collect()}
    keys = sorted(classes)
    want, pairs = groups_by_brute_force([classes[k][1] or "" for k in keys])
    got = {r["class"].hex(): r.root for r in simhash.similar_classes(df).collect()}
    for (i, j), _ in pairs.items():  # recall of each band of similarity is 1
        assert got[keys[i]] == got[keys[j]]
    sizes = Counter(want)
    assert len(got) == sum(sizes[r] > 1 for r in want) and len(set(got.values())) == sum(n > 1 for n in sizes.values())


def test_outlines_allow_similar_sets(spark):
    rng = np.random.default_rng(6)
    rows = []
    for n in (40, 100, 300, 2000):
        for share in (0.5, 0.25, 0.0):  # how the difference is dealt to both
            for _ in range(60):
                pool = np.unique(rng.integers(0, 2**63, int(n * 1.25) + 1, dtype=np.uint64))
                rng.shuffle(pool)
                rest, common = pool[: len(pool) // 5], pool[len(pool) // 5 :]
                cut = int(len(rest) * share)
                rows.append((True, np.concatenate((common, rest[:cut])), np.concatenate((common, rest[cut:]))))
            other = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            rows.append((False, np.concatenate((common, rest)), np.concatenate((common[: len(common) // 20], other))))
    as_list = lambda x: simhash.outline(np.sort(x)).view(np.int64).tolist()
    table = spark.createDataFrame([(s, as_list(a), as_list(b), len(a), len(b)) for s, a, b in rows], "similar boolean, o array<long>, p_o array<long>, n int, p_n int")
    assert {tuple(r) for r in table.select("similar", simhash.plausible(0.8)).distinct().collect()} == {(True, True), (False, False)}


def test_prefixes_lose_no_similar_pair(spark):
    """Random sets, some of them in large groups, through all rounds against brute force."""
    rng = random.Random(5)
    pool = [f"w{i}" for i in range(3000)]
    rows = []
    for _ in range(25):
        base = [rng.choice(pool) for _ in range(rng.randint(20, 150))]
        for _ in range(rng.choice([2, 3, 30])):
            t = list(base)
            for _ in range(rng.randint(0, 4)):
                t[rng.randrange(len(t))] = rng.choice(pool)
            rows.append(" ".join(t[: len(t) - rng.randint(0, len(t) // 8)]))
    want, _ = groups_by_brute_force(rows)
    kept = simhash.keep_one(spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(3))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(want))


# 9 WARC


def test_archives(spark):
    kind = "page_id long, url string, html string, payload string"
    rng = random.Random(6)
    html = ["", "same", *(rng.randbytes(300).hex() for _ in range(40))]
    rows = [(i, f"http://h/{i}", html[i % 42], "extra") for i in range(120)] + [(500, None, None, None)]
    pages = spark.createDataFrame(rows, kind).repartition(4)
    odd_urls = ["http://a/b\r\nfoo", "http://a/\r\n\r\nx", "http://a/\r\nContent-Length: 1", "  http://a/ \t", "http://ü/\x00%20", ""]
    back = warc.read_archives(warc.splits(warc.write_archives(spark.createDataFrame([(i, u, "h", "") for i, u in enumerate(odd_urls)], kind)), 64)).collect()
    assert [r.url for r in sorted(back, key=lambda r: r.page_id)] == odd_urls and all(r.digest_ok for r in back)
    long = spark.createDataFrame([(1, "u" * 100_000, random.Random(1).randbytes(200_000).hex(), None)], kind)
    assert [r.payload_bytes for r in warc.round_trip(long, split_bytes=1000).collect()] == [400_000]
    manifest = warc.write_archives(pages)
    assert warc.deal(warc.splits(manifest, 700)).rdd.getNumPartitions() == warc.splits(manifest, 700).count() > 4
    for split in (700, 1 << 20):  # records cross the ranges
        found = warc.read_archives(warc.splits(manifest, split), with_payload=True).collect()
        assert len(found) == len(rows) and all(r.digest_ok for r in found)
        by_page = {r.page_id: r for r in found}
        last = {}
        for i, _, h, _ in rows:
            last[h or ""] = max(i, last.get(h or "", i))
        for i, _, h, _ in rows:
            payload, r = (h or "").encode(), by_page[i]
            assert r.payload_bytes == len(payload) and r.payload_digest == base64.b32encode(hashlib.sha1(payload).digest()).decode()
            assert (r.record_type, r.refers_to) == (("response", None) if last[h or ""] == i else ("revisit", last[h or ""]))
            assert r.payload == (payload if r.record_type == "response" else b"")
    assert warc.round_trip(pages.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, "u", "x", None), (1, "u", "x", None), (1, "u", "x", None)], kind)
    assert sorted((r.page_id or 0, r.record_type) for r in warc.round_trip(odd).collect()) == [(0, "revisit"), (1, "response"), (1, "response")]


def test_false_members_are_passed_over():
    inner = warc.gzip_member(b"not a record")
    member = warc.gzip_member(warc.record("response", "u", 1, inner * 3, warc.digest(inner * 3)))

    class Bytes:
        def __init__(self, data):
            self.data = data

        def read_at(self, n, at):
            return self.data[at : at + n]

    data = b"junk\x1f\x8b\x08junk" + inner + member + member
    for cut in range(0, len(data), 7):
        found = [o for a, b in ((0, cut), (cut, len(data))) for o, _, _ in warc.read_range(Bytes(data), a, b)]
        assert found == [len(data) - 2 * len(member), len(data) - len(member)]


# 10 language


def test_languages(spark, docs, odd, empty):
    model = language_id.fit_model(docs)
    truth = {r.doc_id: r.lang for r in docs.collect()}
    found = language_id.predict(docs, model).collect()
    out = [r for r in found if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in out) >= 0.95 * len(out)
    length = {r.doc_id: len((r.text or "").encode()) for r in docs.collect()}
    assert all(r.n_positions == length[r.doc_id] or r.lang_pred == "und" for r in found)  # every byte has a label
    by_id = {r.doc_id: r for r in language_id.predict(odd, model).collect()}
    assert by_id[1].lang_pred == by_id[2].lang_pred == by_id[9].lang_pred == "und" and by_id[9].score == 0 and by_id[7].lang_pred != "und"
    assert language_id.predict(empty, model).count() == 0
    assert all(r.lang_pred == "und" for r in language_id.predict(odd, language_id.fit_model(empty)).collect())
    labels = language_id.label_positions(docs.limit(3), model).collect()
    assert labels and all(set(r.labels) <= set(truth.values()) for r in labels)
    kept = language_id.keep_identified(odd, model)
    assert kept.columns == odd.columns and not {1, 2, 3, 9} & {r.doc_id for r in kept.collect()}


def test_equal_texts_have_equal_scores_wherever_they_stand(docs):
    rng = np.random.default_rng(1)
    model = language_id.untrained(["a", "b", "c"], rng)
    texts = [r.text for r in docs.limit(40).collect()]
    pooler = language_id.Pooler(model)
    together = pooler.predict(texts)
    assert together == [pooler.predict([t])[0] for t in texts] == pooler.predict(texts[::-1])[::-1]
    assert pooler.predict([*texts, *texts])[len(texts) :] == together


def test_network_by_plain_loops():
    """Labels of all positions of a text against the network's formulas, a byte at a time, over each stretch and its context."""
    rng = np.random.default_rng(2)
    model = language_id.untrained(["a", "b"], rng, 4)
    data = bytes(rng.integers(97, 123, 500, dtype=np.uint8))
    p = {k: v.astype(np.float64) for k, v in model.params.items()}
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    want = []
    for at in range(0, len(data), language_id.STRETCH):
        low, high = max(0, at - language_id.CONTEXT), min(len(data), at + language_id.STRETCH + language_id.CONTEXT)
        side = []
        for d, name, order in ((0, "pf", range(low, high)), (1, "pb", range(high - 1, low - 1, -1))):
            h, states = np.zeros(4), {}
            for i in order:
                a, x = p["u"][d] @ h, p[name][:, data[i]]
                z, r = sigmoid(x[:4] + a[:4]), sigmoid(x[4:8] + a[4:8])
                h = h + z * (np.tanh(x[8:] + r * a[8:]) - h)
                states[i] = h
            side.append(states)
        for i in range(at, min(at + language_id.STRETCH, len(data))):
            logits = p["v"] @ np.concatenate((side[0][i], side[1][i])) + p["c"]
            want.append(logits - np.log(np.exp(logits).sum()))
    got = np.concatenate([lot.transpose(2, 0, 1)[x.T != 256] for lot, x in language_id.Pooler(model).lots([data])])
    assert np.allclose(got, want, atol=1e-4)
    lang, score, n, share = language_id.Pooler(model).predict([data.decode()])[0]
    total = np.sum(want, 0) * language_id.POOL
    assert lang == "ab"[int(total.argmax())] and n == 500 and score == pytest.approx(1 / np.exp(total - total.max()).sum(), abs=1e-4)
    assert share == pytest.approx(np.mean(np.argmax(want, 1) == total.argmax()), abs=0.01)


def test_thousands_of_languages_are_learnt(spark):
    rows = [(i, prose(i, 12), f"l{i % 2000}") for i in range(12_000)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)
    chosen = language_id.training_rows(table, 3).groupBy("lang").count().collect()
    learnable = {lang for i, _, lang in rows if zlib.crc32(str(i).encode()) % 5}
    assert {r.lang for r in chosen} == learnable and all(1 <= r["count"] <= 3 for r in chosen)
    model = language_id.fit_model(table, 3, steps=2)
    assert set(model.languages) == learnable and language_id.Pooler(model).predict(["a word"])[0][0] in learnable


def test_gradients_by_differences():
    rng = np.random.default_rng(0)
    model = language_id.untrained(["x", "y", "z"], rng, 4)
    model.params = {k: v.astype(np.float64) for k, v in model.params.items()}
    x, y = language_id.padded([b"abc", b"zq", b"hello"], 6), np.array([0, 1, 2])

    def loss():
        logp, _ = model.positions(x)
        there = x != 256
        return -(logp[:, y, np.arange(3)] * there).sum() / there.sum()

    g = model.gradient(x, y)
    for name, a in model.params.items():
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in a.shape) if name not in ("pf", "pb") else (rng.integers(0, a.shape[0]), rng.choice(list(b"abchelo")))
            keep = a[at]
            a[at] = keep + 1e-5
            up = loss()
            a[at] = keep - 1e-5
            down = loss()
            a[at] = keep
            assert (up - down) / 2e-5 == pytest.approx(g[name][at], abs=1e-7)
