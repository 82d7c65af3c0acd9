"""Small fixtures with nulls, empty texts, ties, repeats, clashing columns and empty tables, against plain versions."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from netsift.llm import graph, hashed, language, minhash, packing, pieces, pii, ppm, quality, repair, vectors, warc
from netsift.llm.queries import QUERIES, TOKENIZER

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, score double, kind string, id long"
SPACE = r"[ \t-\r]+"


def docs(spark, texts, first=0):
    return spark.createDataFrame([(i + first, t, 0.5, "x", i) for i, t in enumerate(texts)], DOCS)


@pytest.fixture(scope="module")
def prose():
    import pyarrow.parquet as pq

    return pq.read_table(f"{SF}/documents.parquet").to_pylist()


@pytest.fixture(scope="module")
def odd(prose):
    """Texts of all the odd kinds, with repeats."""
    base = prose[3]["text"]
    return [None, "", " \n\t", "One.", "a b", base, base, base.upper(), base * 30, "x\n\ny\nx\n", "1 2 3", "é ß 日本 😀 don't"]


def folded_words(text):
    return [w for w in re.split(SPACE, re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")) if w]


# words and trie nodes have tests of their own over the whole table
@pytest.mark.parametrize("name", sorted(q for q in QUERIES if q.split("_")[0] not in ("op11", "op13")))
def test_queries_give_whole_tables(spark, name):
    rows = QUERIES[name](spark, SF).collect()
    key, source = {"op3": ("page_id", "pages"), "op4": ("vec_id", "embeddings")}.get(name.split("_")[0], ("doc_id", "documents"))
    assert {r[key] for r in rows} == {r[0] for r in spark.read.parquet(f"{SF}/{source}.parquet").select(key).collect()}


def test_empty_tables(spark):
    none = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int")
    assert language.identify(none, language.train(none.withColumn("lang", F.lit("en")))).count() == 0
    assert quality.judge(none, quality.train(none, labels)).count() == 0
    assert minhash.near_duplicates(none).count() == 0
    assert pii.personal_data(none).count() == 0
    assert packing.pack(none, TOKENIZER()).count() == 0
    assert repair.read(repair.write(none, TOKENIZER())).count() == 0
    assert ppm.score(none, F.lit(True)).count() == 0
    assert vectors.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>, label int")).count() == 0
    assert warc.payloads(warc.write(warc.records(spark.createDataFrame([], "page_id long, url string, html string")))).count() == 0


def test_language_learns_and_rejects(spark, prose, odd):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.train(table.where("doc_id % 4 <> 0"))
    got = {r.doc_id: r for r in language.identify(table, model).collect()}
    held = [d for d in prose if d["doc_id"] % 4 == 0]
    assert np.mean([got[d["doc_id"]].lang_pred == d["lang"] for d in held]) > 0.9
    strange = language.identify(docs(spark, odd), model).orderBy("doc_id").collect()
    for k in (0, 1, 2, 10):
        assert (strange[k].lang_pred, strange[k].score, strange[k].accepted) == ("und", 0.0, False)
    assert language.accepted_rows(docs(spark, odd), model).columns == ["doc_id", "text", "score", "kind", "id"]
    assert language.accepted_rows(docs(spark, []), model).count() == 0
    twice = language.identify(docs(spark, [prose[3]["text"]] * 2).withColumn("doc_id", F.lit(None).cast("long")), model).collect()
    assert len(twice) == 2 and twice[0] == twice[1] and twice[0].doc_id is None
    tied = language.identify(docs(spark, [prose[3]["text"] * 200]), model).first()      # longer than a slice
    assert tied.lang_pred == prose[3]["lang"]


def test_language_rejects_what_it_never_met(spark):
    """Scripts and languages never met, letter junk; rows kept out of training stay but for one in a hundred."""
    table = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = language.train(table.where("doc_id % 4 <> 0"))
    rng = np.random.default_rng(1)
    junk = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz "), int(n))) for n in rng.integers(20, 2000, 100)]
    other = ["Съешь же ещё этих мягких французских булок да выпей чаю, и ещё раз повторим это предложение",
             "これは日本語の文章です。この文は学習されていない言語で書かれています。", "Η γρήγορη καφέ αλεπού πηδά πάνω από το σκυλί"]
    far = language.identify(docs(spark, junk + other), model).orderBy("doc_id").collect()
    assert sum(r.accepted for r in far[:100]) <= 10 and not any(r.accepted for r in far[100:])
    kept = language.identify(table.where("doc_id % 4 = 0"), model).agg(F.avg(F.col("accepted").cast("int"))).first()[0]
    assert kept > 0.99


def test_quality_counts(spark, odd):
    texts = [*odd, "a b c d e f g\na b c d e f g\nz " + "p q r s t " * 3]
    model = quality.Model(np.zeros(1 << 15), 0.0, 1.0, 0.0, 15, False)
    for r, t in zip(quality.judge(docs(spark, texts), model).orderBy("doc_id").collect(), texts):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        count = collections.Counter(tuple(w[k:k + 5]) for k in range(len(w) - 4))
        cover = {k + d for k in range(len(w) - 4) if count[tuple(w[k:k + 5])] > 1 for d in range(5)}
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover))
        assert r.base_failed == (len(w) < 10 or 100 * len(cover) > 20 * len(w)) and r.kept == (not r.base_failed)


def brute_groups(texts, percent, width):
    sets = []
    for t in texts:
        w = folded_words(t)
        sets.append({tuple(w[k:k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set()))
    group = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = group[i], group[j]
                group = [min(a, b) if g in (a, b) else g for g in group]
    return [len(s) for s in sets], group


def test_minhash_equals_brute_force(spark, prose, odd, monkeypatch):
    rng = np.random.default_rng(4)
    texts = [*odd, "One.", "a b", "A  B"]
    base = prose[7]["text"].split()[:120]
    for _ in range(60):  # a family around one text: some pairs link only through others
        w = list(base)
        for k in rng.integers(0, len(w), rng.integers(0, 14)):
            w[k] = f"w{rng.integers(1000)}"
        texts.append(" ".join(w))
    size, group = brute_groups(texts, 80, 2)
    rows = minhash.near_duplicates(docs(spark, texts), width=2).orderBy("doc_id").collect()
    assert [(r.n_shingles, r.component_id) for r in rows] == list(zip(size, group))
    # the splitting way of hot half bands, and many tiles, give the same
    plain = minhash.stars
    monkeypatch.setattr(minhash, "stars", lambda c: plain(c, one_task=3))
    monkeypatch.setattr(minhash, "TILE", 500)
    again = minhash.near_duplicates(docs(spark, texts), width=2).orderBy("doc_id").collect()
    assert [r.component_id for r in again] == group
    one = minhash.one_of_each(docs(spark, texts), width=2)
    assert sorted(r.doc_id for r in one.collect()) == sorted(set(group)) and one.columns == docs(spark, []).columns


def test_components(spark):
    rng = np.random.default_rng(1)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 300, (240, 2))] + [(k, k + 1) for k in range(400, 450)]
    group = {}
    for a, b in pairs:
        group.setdefault(a, a)
        group.setdefault(b, b)
        x, y = group[a], group[b]
        group = {k: min(x, y) if g in (x, y) else g for k, g in group.items()}
    got = {r.id: r.component for r in graph.components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    linked = {x for a, b in pairs if a != b for x in (a, b)}
    assert got == {k: g for k, g in group.items() if k in linked}


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(12, 16))
    rows = [(k, (base[k % 12] + rng.normal(size=16) * 0.09 * (k % 3)).tolist(), k % 2) for k in range(120)]
    rows += [(200, rows[0][1], 0), (201, rows[0][1], 0), (202, None, 0), (203, [0.0] * 16, 0), (204, [math.nan] * 16, 0), (205, [None] * 16, 0),
             (206, rows[0][1], None), (207, [], 0), (None, rows[0][1], 0), (208, [math.inf] * 16, 0), (209, rows[0][1][:3], 0)]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, id int")
    ok = [r for r in rows if r[0] is not None and r[2] is not None and (r[0] < 202)]
    v = np.array([r[1] for r in ok])
    v /= np.linalg.norm(v, axis=1)[:, None]
    link = (v @ v.T >= 0.93) & np.equal.outer([r[2] for r in ok], [r[2] for r in ok]) & ~np.eye(len(ok), dtype=bool)
    group = np.array([r[0] for r in ok])
    while True:
        new = np.array([min([group[i], *group[link[i]]]) for i in range(len(ok))])
        if (new == group).all():
            break
        group = new
    for tile in (2048, 5):
        got = {r.vec_id: r for r in vectors.near_duplicates(table, tile=tile).collect()}
        assert {r[0]: (int(n), int(g)) for r, n, g in zip(ok, link.sum(1), group)} == {
            r[0]: (got[r[0]].n_links, got[r[0]].component_id) for r in ok}
        assert all(got[k].n_links == 0 and got[k].component_id == k for k in (202, 203, 204, 205, 206, 207, 208, 209))


def test_archives(spark):
    html = [None, "", "x" * 99, "x" * 99, "y" * 100, "y" * 100, "é" * 400_000, "é" * 400_000, "a\r\n\r\nWARC/1.1\r\n" * 40]
    pages = spark.createDataFrame([(k, "http://a/\nb" if k % 2 else None, h, 1) for k, h in enumerate(html)],
                                  "page_id long, url string, html string, size int").repartition(3)
    files = warc.write(warc.records(pages), roll=1)
    got = {r.page_id: r for r in warc.payloads(files).collect()}
    for k, h in enumerate(html):
        raw = (h or "").encode()
        first = html.index(h) if len(raw) >= 100 else k
        assert (got[k].payload_bytes, got[k].payload_digest, got[k].record_type, got[k].refers_to) == (
            len(raw), hashlib.sha256(raw).hexdigest(), "response" if first == k else "revisit", None if first == k else first)
    chunks = [r for r in warc.read(files).collect() if r.page_id == 6]
    chunks.sort(key=lambda r: r.chunk_no)
    assert len(chunks) == 4 and b"".join(r.data for r in chunks) == html[6].encode()
    assert chunks[1].digest == hashlib.sha256(html[6].encode()[:2 * warc.CHUNK]).hexdigest()


def test_archive_batches_are_bounded(spark, tmp_path, monkeypatch):
    """A payload of 64 MB goes to the writer in batches of at most BATCH_BYTES, and no row holds more than a chunk."""
    import pyarrow as pa

    big = spark.range(1).select(F.lit(1).cast("long").alias("page_id"), F.lit("http://x/").alias("url"),
                                F.repeat(F.lit("0123456789abcdef"), 4 << 20).alias("html"))
    chunks = warc.records(big)

    def watch(batches):
        rows = [(b.num_rows, sum(len(v.as_py()) for v in b.column("data")), max(len(v.as_py()) for v in b.column("data"))) for b in batches]
        if rows:
            yield pa.RecordBatch.from_pylist([{"rows": r, "held": h, "longest": m} for r, h, m in rows])

    limit = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(limit)
    spark.conf.set(limit, str(warc.BATCH_BYTES // warc.CHUNK))
    seen = chunks.mapInArrow(watch, "rows long, held long, longest long").collect()
    spark.conf.set(limit, before)
    assert sum(r.held for r in seen) == 64 << 20 and max(r.held for r in seen) <= warc.BATCH_BYTES
    assert max(r.longest for r in seen) == warc.CHUNK
    assert [(r.page_id, r.payload_bytes) for r in warc.payloads(warc.write(chunks)).collect()] == [(1, 64 << 20)]
    assert spark.conf.get(limit) == before


def test_archives_of_repeated_and_null_ids(spark):
    rows = [(5, "q" * 200), (5, "q" * 200), (9, "q" * 200), (5, "other" * 100), (None, "q" * 200), (None, None), (7, "short"), (8, "short")]
    pages = spark.createDataFrame([(k, "u", h, "x") for k, h in rows], "page_id long, url string, html string, digest string")
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.payloads(warc.write(warc.records(pages))).collect()), key=str)
    assert got == sorted([(5, 200, "response", None), (5, 200, "response", None), (9, 200, "revisit", 5), (5, 500, "response", None),
                          (None, 200, "response", None), (None, 0, "response", None), (7, 5, "response", None), (8, 5, "response", None)], key=str)


def test_packing(spark, odd, prose):
    from tokenizers import Tokenizer

    texts = [*odd, *[d["text"] for d in prose], "<|endoftext|> b", "it's  'tis\n'll we'd"]
    known = Tokenizer.from_file(TOKENIZER())
    rows = packing.pack(docs(spark, texts), TOKENIZER()).collect()
    ids = [np.array(known.encode(t or "", add_special_tokens=False).ids + [0], "<u4") for t in texts]
    assert sum(r.length for r in rows) == sum(map(len, ids))
    for r in rows:
        own = ids[r.doc_id]
        assert r.ids_crc32 == zlib.crc32(own[r.start:r.start + r.length].tobytes())
        assert r.length == 2048 or r.piece == 0
    by = collections.defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by) <= math.ceil(sum(map(len, ids)) / 2048 * 1.03) + 1


def test_best_fit_opens_sequences_when_no_room_is_left():
    plan, opened = packing.best_fit_plan({30: 2}, {20: 3, 10: 5}, 100)
    assert sum(b - a for _, a, b, _, _ in plan) == 8 and opened == 1


def test_personal_data(spark):
    texts = [None, "", "a@b.co x@y.z.w._q@e.f", "1.2.3.4 300.1.1.1 000255.1.1.1 1.2.3.4.5.6.7.8", "4111 1111 1111 1111 and 4111111111111112",
             "call +1 (377) 555-0271 now +123", "+4111 1111 1111 1111", "a" * 20_000 + "@", "1 " * 5_000, "日本 q@r.st 1.2.3.4"]
    texts += [f"pass {k} the member number 90{k}77{k}1234567890123456{k} ." for k in range(3)]
    kinds = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
             "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}

    def fine(kind, value):
        digits = [int(c) for c in value if c in "0123456789"]
        if kind == "ip":
            return all(int(x) <= 255 for x in value.split("."))
        if kind == "card":
            return 14 <= len(digits) <= 19 and sum(
                d if k % 2 == 0 else 2 * d - 9 * (2 * d > 9) for k, d in enumerate(reversed(digits))) % 10 == 0
        return kind != "phone" or 10 <= len(digits) <= 15

    for r, t in zip(pii.personal_data(docs(spark, texts)).orderBy("doc_id").collect(), texts):
        found = []
        if len(t or "") < 15_000:
            found = sorted((m.start(), n, f"{k}:{m.start()}:{m.end()}") for n, (k, p) in enumerate(kinds.items())
                           for m in re.finditer(p, t or "") if fine(k, m.group()))
        text = ",".join(x[2] for x in found)
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest(), t
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(sum(x[1] == n for x in found) for n in range(4))


def test_contexts_find_unseen_identifiers(spark):
    seeds = [f"please mail ref: user{k}@site{k}.org done thanks and more words" for k in range(40)]
    hidden = ["please mail ref: user(at)123456789 done thanks", "order 123456789 items today"]
    table = docs(spark, seeds + hidden)
    rows = {r.doc_id: r.spans for r in pii.personal_data(table).collect()}
    assert rows[40] == "email:17:34" and rows[41] == ""
    masked = {r.doc_id: r for r in pii.masked(table.withColumn("n_chars", F.length("text").cast("long"))).collect()}
    assert masked[40].text == "please mail ref: <EMAIL> done thanks" and masked[40].n_chars == len(masked[40].text)
    assert masked[41].text == hidden[1]


def test_contexts_find_values_of_other_shapes(spark):
    """Values with blanks, glued cues, no digits or few; numbers and names beside other words are left alone."""
    seeds = [f"phone: +1 (377) 555-{1000 + k} today" for k in range(60)] + [f"email: user{k}@site{k}.org now" for k in range(60)]
    hidden = ["phone: 555-123-4567 ok", "phone: (555)123-4567 ok", "phone:\t555.123.4567", "phone: 555 123 4567 ok", "Phone:5551234567 ok", "phone: 12345\nx",
              "email: john(at)site.org ok", "email: john at site dot org ok", "email: j.smith_no-domain ok"]
    values = ["555-123-4567", "555)123-4567", "555.123.4567", "555 123 4567", "5551234567", "12345", "john(at)site.org", "john at site dot org", "j.smith_no-domain"]
    plain = [f"order {10_000_000 + 37 * k} shipped, part no-{k} well-known e.g. look at this dot here, total 555 123 {k + 1000}" for k in range(200)]
    plain += ["phone: none given", "email: see below", "phone: x-ray 12 ok", "order: 5551234568 ok"]
    rows = {r.doc_id: r for r in pii.personal_data(docs(spark, seeds + hidden + plain)).collect()}
    for k, (text, value) in enumerate(zip(hidden, values)):
        at = text.index(value)
        kind = "phone" if text.lower().startswith("phone") else "email"
        assert rows[120 + k].spans == f"{kind}:{at}:{at + len(value)}", (text, rows[120 + k].spans)
    found = sum(rows[129 + k].spans != "" for k in range(len(plain)))
    assert found == 0                    # precision on look-alikes: no span in 204 texts


def test_personal_data_of_repeated_and_null_ids(spark):
    text = "a@b.co 1.2.3.4"
    table = docs(spark, [text, text, None, ""]).withColumn("doc_id", F.when(F.col("id") < 1, 5).cast("long"))
    got = pii.personal_data(table).collect()
    assert sorted(r.spans for r in got) == ["", "", "email:0:6,ip:7:14", "email:0:6,ip:7:14"]
    assert sorted(r.text or "" for r in pii.masked(table).collect()) == ["", "", "<EMAIL> <IP>", "<EMAIL> <IP>"]
    assert pii.masked(table.where("false")).count() == 0


def test_grammar_files(spark, odd):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(TOKENIZER())
    texts = [*odd, "ab ab ab " * 3000]
    rows = {r.doc_id: r for r in repair.read(repair.write(docs(spark, texts), TOKENIZER(), shard_tokens=4000)).collect()}
    at = 0
    for k, t in enumerate(texts):
        ids = np.array(known.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        assert (rows[k].start, rows[k].n_tokens, rows[k].ids_crc32) == (at, len(ids), zlib.crc32(ids.tobytes()))
        at += len(ids)


def test_grammar_random_access():
    import pyarrow as pa

    rng = np.random.default_rng(3)
    ids = [rng.choice(50, int(rng.integers(0, 400)), p=np.arange(1, 51) / 1275).astype(np.uint32) for _ in range(60)]
    ids[30:] = ids[:30]
    raw = repair.pack_shard(pa.array(range(60)), ids, 50_257, 2)
    shard = repair.read_shard(raw)
    assert len(shard.rules)
    for k in (0, len(shard.rules) - 1):
        assert len(repair.expand(np.array([50_257 + k]), shard.rules, 50_257)) == shard.rule_size[k]
    for k in (0, 13, 59):
        assert shard.ids(k)[:-1].tolist() == ids[k].tolist()


def test_pieces(spark, odd):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    own = sentencepiece.SentencePieceProcessor(model_file=path)
    texts = [*odd, "  lead", "trail ", "a▁b \0", " ", "   "]
    for r, t in zip(pieces.encode(docs(spark, texts), path).orderBy("doc_id").collect(), texts):
        want = own.encode(t or "", return_type="proto").pieces
        assert r.ids == [own.bos_id(), *[p.id for p in want], own.eos_id()] and r.decoded == own.decode(r.ids)
        assert list(zip(r.begins, r.ends))[1:-1] == [(p.begin, p.end) for p in want]


def test_normaliser_follows_compiled_map():
    import sentencepiece

    lib = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    own = pieces.Normalizer.of_spec(lib.serialized_normalizer_spec())
    for t in ["ﬁ Ｋａ  ①x ", "", "  ", "㌔ ｶﾞ é", "a​b … ½"]:
        assert own(t)[0].decode() == lib.normalize(t)


def test_language_model(spark, odd, prose):
    texts = [*odd, *[d["text"] for d in prose[:40]]]
    rows = ppm.score(docs(spark, texts), F.col("doc_id") % 3 != 0).orderBy("doc_id").collect()
    learned = [t for k, t in enumerate(texts) if k % 3]
    count = collections.Counter(w for t in learned for w in [*folded_words(t), None])
    n, v = sum(count.values()), len(count)
    follow = collections.defaultdict(collections.Counter)

    def marks(t):
        raw = re.sub("[A-Z]+", lambda m: m.group().lower(), t or "").encode()
        return bytes([ppm.START] * ppm.ORDER) + raw + bytes([ppm.END])

    for t in learned:
        raw = marks(t)
        for k in range(ppm.ORDER, len(raw)):
            for o in range(ppm.ORDER + 1):
                follow[raw[k - o:k]][raw[k]] += 1

    def code(context, symbol):
        out, total = set(), 0.0
        for o in range(ppm.ORDER, -1, -1):
            seen = {s: c for s, c in follow[context[len(context) - o:]].items() if s not in out}
            if not seen:
                continue
            room = sum(seen.values()) + len(seen)
            if symbol in seen:
                return total + math.log10(seen[symbol] / room)
            total += math.log10(len(seen) / room)
            out |= set(seen)
        return total - math.log10(ppm.SYMBOLS - len(out))

    for r, t in zip(rows, texts):
        words, raw = [*folded_words(t), None], marks(t)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(words), sum(count[w] > 0 for w in words), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[w] + 0.1) / (n + 0.1 * (v + 1))) for w in words), rel=1e-9)
        assert r.score == pytest.approx(sum(code(raw[k - ppm.ORDER:k], raw[k]) for k in range(ppm.ORDER, len(raw))), rel=1e-9)


def test_training_sample_is_bounded(spark):
    table = docs(spark, [f"text number {k}" for k in range(50)]).withColumn("lang", F.lit("en"))
    got = hashed.training_bags(table.unionByName(table), "lang", 7, hashed.Features(10))
    assert 0 < len(got) <= 7 and len({r["doc_id"] for r in got}) == len(got)


def test_pipeline_stages(spark):
    import corpus_pipeline

    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs_now, sizes = table, []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs_now = stage(spark, docs_now, SF)
        assert docs_now.columns == table.columns
        sizes.append(docs_now.count())
    assert sizes == sorted(sizes, reverse=True) and sizes[2] < sizes[1] < table.count() and sizes[3] == sizes[2]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs_now, SF)
    assert packed.select("doc_id").distinct().count() == sizes[3]


def test_word_memory_overflow_keeps_ids(monkeypatch):
    import pyarrow as pa

    from netsift.llm import kernel, queries, tokens

    monkeypatch.setattr(tokens, "WORDS_KEPT", 40)
    texts = ["", "  a  b\n\n c 's don't WE'LL <|endoftext|> x", "日本語 text ñandú 123abc", "\t\ttabs\r\n n", "x" * 5000]
    texts += [" ".join(f"w{k * n}z" for k in range(30)) for n in range(1, 6)]
    encode = tokens.WordEncoder(queries.TOKENIZER())
    for text in texts * 2:
        for _, _, data, off, _ in kernel.parts(pa.array([text])):
            ids, _ = encode(data, off)
            assert ids.tolist() == encode.tokenizer.encode(text, add_special_tokens=False).ids


def test_training_rows_of_parts_are_the_first_of_each_label(spark):
    rows = [(k, f"text {k}", "a" if k % 3 else "b") for k in range(400)] + [(7, "text 7", "a"), (None, "x", "a"), (900, None, "a")]
    own = spark.createDataFrame(rows, "doc_id long, text string, label string")
    sound = own.where("doc_id is not null and text is not null").selectExpr("doc_id", "label", "xxhash64(doc_id) h").collect()
    expected = []
    for label in "ab":
        first = sorted((r["h"], r["doc_id"]) for r in sound if r["label"] == label)[:50]
        expected += {(d, label) for _, d in first}
    features = hashed.Features(8)
    inside = hashed.training_bags(own, "label", 50, features)
    joined = hashed.training_bags(own.select("doc_id", "text"), "label", 50, features, own.select("doc_id", "label").distinct())
    assert [(r["doc_id"], r["label"]) for r in inside] == sorted(expected)
    assert [(r["doc_id"], r["label"]) for r in joined] == sorted(expected)


def test_one_sided_cues_find_identifiers(spark):
    """A cue before, or behind, a value is enough; what stands on the other side, or on the next line, does not count."""
    words = [f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(80)]
    seeds = [f"{words[k]} phone: +1 (377) 555-01{k:02d} {words[k]} more" for k in range(40)]
    seeds += [f"{words[k]} u{k}@site.org wrote this" for k in range(40)]
    hidden = ["x phone: 5551234567 tomorrow", "y phone: 5551234568\nNext", "z phone: 5551234569", "then 5551234570\nphone: 5551234571 or",
              "when user(at)777777 wrote this", "user(at)888888\nwrote this", "the phone: 5551234572 a\nno phone 5551234572 b"]
    rows = {r.doc_id: r.spans for r in pii.personal_data(docs(spark, seeds + hidden)).collect()}
    assert [rows[80 + k] for k in range(len(hidden))] == [
        "phone:9:19", "phone:9:19", "phone:9:19", "phone:23:33", "email:5:19", "", ""]


def test_found_identifiers_make_further_cues(spark):
    """No seed stands behind ``mobile``: only values that were found behind ``phone:`` vouch for it."""
    seeds = ["".join(f"a phone: +1 (377) 555-01{k % 90 + 10} b\n" for k in range(3000)) for _ in range(4)]
    known = [f"x phone: 55512345{k:02d} y\n" * 20 + f"mobile 55512345{k:02d} y" for k in range(30)]
    rows = {r.doc_id: r.spans for r in pii.personal_data(docs(spark, [*seeds, *known, "my mobile 5559876543 z", "q order 999999999 r"])).collect()}
    assert rows[4].count("phone:") == 21 and rows[34] == "phone:10:20" and rows[35] == ""


def test_members_by_a_chain_are_compared_with_far_classes(spark):
    """x is in the pivot's group through c; y is like x and unlike the pivot."""
    p, c, x, y = (list(range(k, k + 100)) for k in (0, 10, 20, 30))
    full = spark.createDataFrame([(1, p), (2, c), (3, x), (4, y)], "id long, shingles array<long>")
    rows = [(1, k, 100, len({*p} & {*v}), len({*p} | {*v})) for k, v in ((2, c), (3, x), (4, y))]
    compared = spark.createDataFrame(rows, "pivot long, id long, size int, shared int, union int").withColumn(
        "linked", F.expr("shared * 100 >= union * 80"))
    groups = spark.createDataFrame([(1, 1), (2, 1), (3, 1)], "id long, component long")
    assert [tuple(r) for r in minhash._among_partners(compared, groups, full, 80).collect()] == [(4, 3)]


def test_grammar_folds_long_repeats():
    import pyarrow as pa

    one = np.random.default_rng(5).permutation(4096).astype(np.uint32)
    shard = repair.read_shard(repair.pack_shard(pa.array(range(40)), [one] * 40, 50_257, 2))
    assert len(shard.symbols) == 40 and all(shard.ids(k)[:-1].tolist() == one.tolist() for k in (0, 39))
    rare = repair.read_shard(repair.pack_shard(pa.array(range(5)), [one[:2]] * 5, 50_257, 2))
    assert len(rare.rules) == 1


@pytest.mark.parametrize("vocabulary,number", [(70_000, 65_535), (70_000, 66_000), (100, 100)])
def test_grammar_refuses_ids_that_do_not_fit(vocabulary, number):
    import pyarrow as pa

    with pytest.raises(ValueError):
        repair.pack_shard(pa.array([1]), [np.array([1, number], np.uint32)], vocabulary, 2)


def test_training_bags_reach_the_driver_without_a_collect(spark, monkeypatch):
    from pyspark.sql import DataFrame

    rows = [(i, f"word{i % 7} other{i % 3} text {i}", i % 2) for i in range(200, 0, -1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, q int")

    def refuse(self):
        raise AssertionError("training bags must not be collected whole")

    monkeypatch.setattr(DataFrame, "collect", refuse)
    got = hashed.training_bags(df, "q", 40, hashed.Features(12))
    assert len(got) == 80 and sorted(r["label"] for r in got) == [0] * 40 + [1] * 40
    assert [r["doc_id"] for r in got] == sorted(r["doc_id"] for r in got)
    assert all(len(r["idx"]) == len(r["share"]) > 0 for r in got)
