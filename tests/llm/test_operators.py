"""Each operator against brute force, and on awkward and empty tables."""

import glob
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from tokenizers import Tokenizer

import public_tokenizers
from subtide.llm import bpe, decontamination, html_crf, licences, quality_ranking, quality_rules, sharding, simhash, token_files, toxicity
from tests.llm.samples import TEXTS, awkward, empty, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
ASCII_LOWER = {n: n + 32 for n in range(65, 91)}


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


@pytest.fixture(scope="module")
def docs(spark):
    return awkward(spark).cache()


# --- 1 and 2: tokens ---------------------------------------------------------


def test_encoding_and_decoding_equal_the_library(docs, library):
    rows = bpe.encode_documents(docs, PATH, decoded=True).collect()
    assert len(rows) == docs.count()
    again = bpe.decode_documents(bpe.encode_documents(docs, PATH), PATH).collect()
    assert [r.decoded for r in again] == [r.decoded for r in rows]
    for row in rows:
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == ids
        assert row.decoded == library.decode(ids, skip_special_tokens=False)
    assert rows[0].N_Words == "old"


def test_encoding_equals_the_library_on_mixed_pieces(library):
    coder = bpe.byte_bpe(PATH)
    texts = [prose(seed, seed % 50) for seed in range(200)] + ["don't.  I'll,we've\n\n x", "a. b, c.\nd", "1,000.5 ... ,,, . ,"]
    ids, lengths = coder.encode(texts)
    ends = np.cumsum(lengths)
    for text, end, length in zip(texts, ends, lengths):
        assert ids[end - length : end].tolist() == library.encode(text, add_special_tokens=False).ids, text


def test_a_coder_that_forgets_gives_the_same_ids(monkeypatch, library):
    coder = bpe.ByteBPE(PATH)
    monkeypatch.setattr(bpe, "MEMORY", 0)
    for seed in range(20):
        text = prose(seed, 80)
        assert coder.encode([text])[0].tolist() == library.encode(text, add_special_tokens=False).ids
        assert len(coder.chunks) <= 200


def test_decoding_takes_ids_in_any_order(spark, library):
    lists = [[5, 300, 40_000, 7], [], None, [220, 221, 222]]
    rows = bpe.decode_documents(spark.createDataFrame([(x,) for x in lists], "ids array<int>"), PATH).collect()
    assert [r.decoded for r in rows] == [library.decode(x or [], skip_special_tokens=False) for x in lists]


def test_encoding_an_empty_table(spark):
    assert bpe.decode_documents(bpe.encode_documents(empty(spark), PATH), PATH).count() == 0


@pytest.mark.parametrize("encoding", ["dictionary", "delta"])
def test_token_files_round_trip(spark, docs, library, folder, encoding):
    out = folder + "/tokens"
    token_files.write_token_files(docs, PATH, out, 2, encoding)
    files = token_files.read_token_files(spark, out)
    rows = token_files.with_starts(token_files.with_checksums(files), files).collect()
    want = Counter()
    for row in docs.collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids + [2]
        want[row.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == want
    at = 0
    for row in sorted(rows, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    ordered = [r.doc_id for r in sorted(rows, key=lambda r: r.start)]
    assert ordered == sorted(ordered, key=lambda x: (x is not None, x or 0))


@pytest.mark.parametrize("encoding, wanted", [("dictionary", "PLAIN_DICTIONARY"), ("delta", "DELTA_BINARY_PACKED")])
def test_token_files_have_the_chosen_layout(spark, folder, encoding, wanted):
    """Encodings, row groups and page indexes as the footers tell them; a read of lengths leaves the ids alone."""
    out = folder + "/tokens"
    rng = np.random.default_rng(1)
    texts = [(n, " ".join(f"w{x}" for x in rng.integers(0, 10**9, 600))) for n in range(1200)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(1)
    token_files.write_token_files(docs, PATH, out, 2, encoding, row_group_mb=1, page_rows=100)
    files = sorted(glob.glob(out + "/*.parquet"))
    metas = [pq.ParquetFile(f).metadata for f in files]
    groups = [m.row_group(g) for m in metas for g in range(m.num_row_groups)]
    assert len(groups) > len(metas) and max(g.total_byte_size for g in groups) < 3 << 20
    for group in groups:
        columns = {group.column(c).path_in_schema: group.column(c) for c in range(group.num_columns)}
        assert wanted in columns["ids.list.element"].encodings
        assert all(c.has_offset_index for c in columns.values())
        assert columns["doc_id"].has_column_index and columns["doc_id"].statistics.has_min_max
        assert columns["ids.list.element"].total_compressed_size > 20 * columns["n_tokens"].total_compressed_size
    ranges = [(g.column(0).statistics.min, g.column(0).statistics.max) for g in groups]
    assert all(a[1] <= b[0] for a, b in zip(ranges, ranges[1:]))
    some = token_files.read_token_files(spark, out).where("doc_id BETWEEN 700 AND 703").select("doc_id", "n_tokens")
    text = some._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<doc_id:bigint,n_tokens:bigint>" in text and "GreaterThanOrEqual(doc_id,700)" in text
    assert [r.doc_id for r in some.collect()] == [700, 701, 702, 703]


def test_equal_ids_are_dealt_out(spark, folder):
    """Documents without an id, or with one and the same, do not meet in one file."""
    out = folder + "/tokens"
    docs = spark.createDataFrame([(None, f"text {n} " * 50) for n in range(4000)], "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    token_files.write_token_files(docs, PATH, out, 2)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = token_files.read_token_files(spark, out)
    counts = [r["count"] for r in files.groupBy("part").count().collect()]
    assert sum(counts) == 4000 and max(counts) < 2500


def test_token_files_of_an_empty_table(spark, folder):
    out = folder + "/tokens"
    token_files.write_token_files(empty(spark), PATH, out, 2)
    files = token_files.read_token_files(spark, out)
    assert token_files.with_starts(token_files.with_checksums(files), files).count() == 0


# --- 3: licences -------------------------------------------------------------


def _words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def _dice(a, b):
    x, y = Counter(zip(a, a[1:])), Counter(zip(b, b[1:]))
    return 2 * sum((x & y).values()) / (x.total() + y.total())


def test_licences_equal_all_pairs(spark):
    name, template = next(iter(licences.TEMPLATES.items()))
    cut = " ".join(template.split()[: int(len(template.split()) * 0.9)])
    texts = [*TEXTS, template, template.upper(), cut, "Foreword.\n" + template + "\nAfterword of some length.", *licences.TEMPLATES.values()]
    known = {n: _words(t) for n, t in licences.TEMPLATES.items()}
    rows = licences.scan(awkward(spark, texts)).collect()
    assert len(rows) == len(texts) + 2
    found = 0
    for row in rows:
        text = row.text or ""
        units = [text, *text.split("\n")] if "\n" in text else [text]
        hits = []
        for words in map(_words, units):
            scores = [(-_dice(words, t), n) for n, t in known.items() if len(words) > 1 and len(t) > 1]
            scores = [s for s in scores if -s[0] >= licences.THRESHOLD]
            hits += [min(scores)] if scores else []
        words = _words(text) if len(text) < 20_000 else []
        windows = [(-_dice(words[p : p + len(t)], t), n) for n, t in known.items() for p in range(len(words) - len(t) + 1)]
        windows = [w for w in windows if -w[0] >= licences.THRESHOLD]
        dice, licence = min(hits + windows, default=(0.0, ""))
        assert (row.licence, row.n_units, row.n_windows) == (licence, len(hits), len(windows))
        assert row.dice == pytest.approx(-dice)
        found += bool(hits)
    assert found >= len(known) + 3
    assert licences.scan(empty(spark)).count() == 0


def test_licences_wrapped_commented_and_edited(spark):
    """Recall over every template: wrapped at 72 columns behind comment marks, with a word in twenty changed, amid 80 lines of code."""
    import textwrap

    code = "\n".join(f"value_{n} = compute(value_{n - 1}, {n})" for n in range(80))
    texts, names = [], []
    for name, template in licences.TEMPLATES.items():
        words = template.split()
        edited = [f"other{n}" if n % 20 == 10 and len(words) > 20 else w for n, w in enumerate(words)]
        for mark in ("# ", " * ", "// ", "-- "):
            for body in (words, edited):
                notice = "\n".join(mark + line for line in textwrap.wrap("Copyright 2024 Somebody. " + " ".join(body), 72))
                texts += [notice + "\n" + code, code + "\n" + notice + "\n" + code]
                names += [name, name]
    texts.append(code)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in licences.scan(docs).collect()}
    matcher = licences.Matcher(licences.TEMPLATES, licences.THRESHOLD)
    found = [matcher.windows(text.encode())[1][1] != "" for text in texts[:-1]]
    assert sum(found) / len(found) >= 0.95
    # Some templates are contained in longer ones: the family must agree.
    same = [rows[n].licence.split()[0] == name.split()[0] for n, name in enumerate(names)]
    assert sum(same) / len(same) >= 0.95
    assert rows[len(texts) - 1].licence == "" and rows[len(texts) - 1].n_windows == 0


def test_licence_windows_slide_like_counting_anew():
    coded = [int(c) for c in np.random.default_rng(3).integers(-1, 4, 300)]
    counts = [2, 1, 0, 3, 0]
    starts = [0, 1, 2, 9, 10, 40, 41, 290]
    expected = []
    for p in starts:
        own = Counter(c for c in coded[p : p + 10] if c >= 0)
        expected.append(sum(min(n, counts[c]) for c, n in own.items()))
    assert licences.shared_bigrams(coded, counts, 10, starts) == expected


# --- 4: decontamination ------------------------------------------------------


def _hits(text, items, window=13):
    words, hit, names = _words(text), set(), set()
    for name, item in items:
        own = _words(item)
        size = min(window, len(own))
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)} if own else set()
        for i in range(len(words) - size + 1):
            if own and tuple(words[i : i + size]) in windows:
                hit.update(range(i, i + size))
                names.add(name)
    return len(words), sorted(hit), sorted(n for n in names if n is not None)


ITEM = "which of these seven rivers flows past the old stone bridge before it meets the northern sea at dusk"
ITEMS = [("q1", ITEM), ("q1", ITEM), ("q2", "Short item here"), ("q3", None), ("q4", ""), (None, "an item without any id"), ("q10", ITEM.upper() + " again")]
DIRTY = [
    f"Intro. {ITEM}. Outro.",
    "x " * 1000 + ITEM,
    ITEM.replace(" ", "--").upper(),
    "short ITEM, here",
    "this is an item without any id at all",
    " ".join(ITEM.split()[:12]),
    (ITEM + " ") * 3,
]


@pytest.mark.parametrize("block_words", [decontamination.BLOCK_WORDS, 12])
def test_contamination_equals_brute_force(spark, block_words):
    docs, items = awkward(spark, [*TEXTS, *DIRTY]), spark.createDataFrame(ITEMS, "item_id string, text string")
    rows = decontamination.find_spans(docs, items, block_words=block_words).collect()
    assert len(rows) == docs.count()
    for row in rows:
        n_words, hit, names = _hits(row.text, ITEMS)
        assert (row.n_words, row.n_hit, list(row["items"])) == (n_words, len(hit), names)
        assert [p for s in row.spans for p in range(s["first"], s["last"] + 1)] == hit
    kept = decontamination.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    want = [r.text for r in docs.collect() if not ((h := _hits(r.text, ITEMS))[1] and 20 * len(h[1]) >= h[0])]
    assert sorted(map(str, (r.text for r in kept.collect()))) == sorted(map(str, want))
    assert decontamination.find_spans(empty(spark), items).count() == 0


def test_contamination_without_items(spark, docs):
    none = spark.createDataFrame([], "item_id string, text string")
    assert {r.n_hit for r in decontamination.find_spans(docs, none).collect()} == {0}
    assert decontamination.drop_contaminated(docs, none).count() == docs.count()


def test_spans_are_cut_out(spark):
    items = spark.createDataFrame(ITEMS[:1], "item_id string, text string")
    rows = decontamination.remove_spans(awkward(spark, [None, "", DIRTY[0], "clean text"]), items).collect()
    assert [r.text for r in rows][:3] == [None, "", "Intro. . Outro."]


# --- 5: SimHash --------------------------------------------------------------


def _fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = np.array([xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles], np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > len(hashes))


def _classes(ids, prints, radius=4):
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= radius:
                root[find(a)] = find(b)
    lowest = {}
    for n, name in enumerate(ids):
        lowest[find(n)] = min(lowest.get(find(n), name), name)
    return [lowest[find(n)] for n in range(len(ids))]


def test_simhash_equals_all_pairs(spark):
    base = prose(9, 400).split()
    near = [" ".join([*base[:n], "changed", *base[n + 1 :]]) for n in range(0, 400, 10)]
    docs = awkward(spark, [*TEXTS, *near])
    rows = [r for r in simhash.near_duplicates(docs).collect() if r.doc_id is not None]
    texts = {r.doc_id: r.text for r in docs.collect()}
    ids = [r.doc_id for r in rows]
    prints = [_fingerprint(texts[i]) for i in ids]
    assert [r.fp & 2**64 - 1 for r in rows] == prints
    assert [r.component_id for r in rows] == _classes(ids, prints)
    assert len(set(_classes(ids, prints))) < len(set(prints))
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(_classes(ids, prints)))


def test_links_keep_the_components_of_random_prints(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(-(2**63), 2**63, 40)
    prints = set(centres.tolist())
    for _ in range(1500):
        value = int(rng.choice(centres)) & 2**64 - 1
        for bit in rng.choice(64, rng.integers(0, 7), replace=False):
            value ^= 1 << int(bit)
        prints.add(value - 2**64 if value >= 2**63 else value)
    prints = sorted(prints)
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    roots = {r.fp: r.root for r in simhash.fingerprint_components(df).collect()}
    assert [roots.get(p, p) for p in prints] == _classes(prints, [p & 2**64 - 1 for p in prints])


def test_simhash_of_an_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).count() == 0
    assert simhash.drop_near_duplicates(empty(spark)).count() == 0


# --- 6: HTML -----------------------------------------------------------------


@pytest.fixture(scope="module")
def field(spark):
    return html_crf.train(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


def test_html_main_text(spark, field):
    story = "".join(f"<p>Paragraph {n} of the story &amp; its\n  many   words, told at length.</p>" for n in range(8))
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=/>Home</a></li><li><a href=/n>News</a></li></ul></nav>"
        f"<article><h1>Headline of the day</h1>{story}</article><script>var a='<p>no</p>'</script>"
        "<aside class=sidebar><p>Related links</p></aside><footer><p>Copyright 2024</p></footer></body></html>"
    )
    rows = html_crf.extract(spark.createDataFrame([(1, page, "old"), (2, None, "old"), (3, "", "old"), (4, "<p", "old")], "page_id long, html string, text string"), field).collect()
    wanted = [f"Paragraph {n} of the story & its many words, told at length." for n in range(8)]
    assert rows[0].text.split("\n")[-8:] == wanted
    assert not re.search("Home|Related|Copyright|var a", rows[0].text)
    assert [(r.text, r.n_chars) for r in rows[1:3]] == [("", 0), ("", 0)]
    assert all(len(r.text) == r.n_chars for r in rows)


def test_viterbi_finds_the_best_path(field):
    blocks = html_crf.blocks_of("<body><nav><p>Home</p></nav><p>One sentence stands here.</p><p>Another one.</p><footer>End</footer></body>")
    assert len(field.label(blocks)) == len(blocks) == 4
    assert field.label([]) == []


@pytest.mark.parametrize(
    "page, text",
    [
        ('<p title="a > b">hi</p>', "hi"),
        ('<a href="u?a<b">y</a>', "y"),
        ("<p title='x>\"y'>z</p>", "z"),
        ('<p class=a">x</p>', "x"),
        ('<p title="abc>text</p>', "text"),
        ("<p>1 < 2</p>", "1 < 2"),
    ],
)
def test_html_quoted_attributes(page, text):
    assert [b.text for b in html_crf.blocks_of(page)] == [text]


def test_html_best_labels_and_gradient_by_all_labellings():
    """Viterbi against every labelling, and the fitted weights at a maximum of the penalised likelihood counted the same way."""
    from itertools import product

    pages = []
    for words, labels in (("menu|One sentence, with commas.|more text here.|end", [0, 1, 1, 0]), ("a|b c d e f g.|h", [0, 1, 0])):
        blocks = [html_crf.Block(t, 0, ("in p", f"name n{n % 2}")) for n, t in enumerate(words.split("|"))]
        pages.append((blocks, labels))
    model = html_crf.fit(pages)

    def score(model, blocks, labels):
        own = sum(sum(model.weights.get(f, 0.0) for f in names) for names, y in zip(html_crf.features(blocks), labels) if y)
        return own + sum(model.pairs[a, b] for a, b in zip(labels, labels[1:]))

    def loss(model):
        total = 0.0
        for blocks, labels in pages:
            every = [score(model, blocks, y) for y in product((0, 1), repeat=len(blocks))]
            total += (np.logaddexp.reduce(every) - score(model, blocks, labels)) / len(pages)
        values = [*model.weights.values(), *model.pairs.ravel()]
        return total + html_crf.DECAY / 2 * sum(v * v for v in values)

    for blocks, _ in pages:
        best = max(product((0, 1), repeat=len(blocks)), key=lambda y: score(model, blocks, y))
        assert score(model, blocks, model.label(blocks)) == pytest.approx(score(model, blocks, best))
    at = loss(model)
    for name in list(model.weights)[:8]:
        slope = []
        for step in (1e-4, -1e-4):
            moved = html_crf.Field({**model.weights, name: model.weights[name] + step}, model.pairs)
            slope.append(loss(moved))
        assert abs(slope[0] - slope[1]) / 2e-4 < 0.02
    assert at < loss(html_crf.Field({}, np.zeros((2, 2))))


def test_html_without_pages_to_learn_from(spark):
    none = spark.createDataFrame([], "page_id long, html string")
    assert html_crf.extract(none, html_crf.train(none)).count() == 0


# --- 7: sharding -------------------------------------------------------------


def test_shards_are_exact_and_slots_gapless(spark, docs):
    rows = sharding.assign(docs, 7).collect()
    total = docs.count()
    assert len(rows) == total
    slots = {}
    for row in rows:
        slots.setdefault(row.shard, []).append(row.slot)
    counts = [len(slots.get(s, [])) for s in range(7)]
    assert max(counts) - min(counts) <= 1
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())
    want = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == want
    assert sharding.assign(empty(spark), 7).count() == 0


def test_matrix_rows_and_columns_add_up():
    for seed in range(20):
        matrix = sharding.communication_matrix([5, 0, 40, 3], [12, 12, 12, 12], seed)
        assert np.asarray(matrix).sum(axis=1).tolist() == [5, 0, 40, 3]
        assert np.asarray(matrix).sum(axis=0).tolist() == [12] * 4


@pytest.mark.parametrize("cells", [1, 9, 1000])
def test_matrix_in_blocks_follows_the_same_law(cells):
    rows, shards, runs = [6, 0, 9, 3, 12], [10, 10, 10], 3000
    drawn = []
    for seed in range(runs):
        blocks = list(sharding.matrix_blocks(rows, shards, seed, cells))
        assert [start for start, _ in blocks] == list(range(0, 5, max(1, cells // 3)))
        drawn.append(np.vstack([block for _, block in blocks]))
        assert drawn[-1].sum(axis=1).tolist() == rows and drawn[-1].sum(axis=0).tolist() == shards
    for n, row in enumerate(rows):
        assert np.mean([m[n, 1] for m in drawn]) == pytest.approx(row / 3, abs=0.12)
        assert np.var([m[n, 1] for m in drawn]) == pytest.approx(row * 2 / 9 * (30 - row) / 29, rel=0.15, abs=1e-9)
    # Two partitions share the places of a shard.
    expected = -6 * 9 * 2 / 9 / 29
    assert np.cov([m[0, 0] for m in drawn], [m[2, 0] for m in drawn])[0, 1] == pytest.approx(expected, abs=0.1)


def test_shuffle_is_uniform_over_seeds(spark, monkeypatch):
    """Rows of each partition over shards and slots, added up over seeds, against equal shares; several matrix blocks."""
    monkeypatch.setattr(sharding, "matrix_blocks", lambda *a, f=sharding.matrix_blocks: f(*a, 16))
    docs = spark.range(400).repartition(4).selectExpr("id AS doc_id", "concat('text ', id) AS text").cache()
    part = {r.doc_id: r.p for r in docs.selectExpr("doc_id", "spark_partition_id() AS p").collect()}
    where = Counter()
    seeds = 5
    for seed in range(seeds):
        where.update((part[r.doc_id], r.shard, r.slot // 10) for r in sharding.assign(docs, 8, seed).collect())
    assert where.total() == 400 * seeds
    sizes = Counter(part.values())
    chi = sum((where[p, s, k] - n * seeds / 40) ** 2 / (n * seeds / 40) for p, n in sizes.items() for s in range(8) for k in range(5))
    # 160 cells with fixed sums: about 117 degrees of freedom.
    assert 117 - 4 * (2 * 117) ** 0.5 < chi < 117 + 4 * (2 * 117) ** 0.5


def test_large_draws_follow_the_same_law(monkeypatch):
    monkeypatch.setattr(sharding, "NUMPY_ROWS", 0)
    draws = [sharding.draw_good(np.random.default_rng(n), 30, 70, 20) for n in range(4000)]
    assert np.mean(draws) == pytest.approx(6, abs=0.15)
    assert np.var(draws) == pytest.approx(20 * 0.3 * 0.7 * 80 / 99, rel=0.12)


# --- 8 and 10: classifiers ---------------------------------------------------


@pytest.mark.parametrize("module, label, drop", [(quality_ranking, "quality", "drop_low_quality"), (toxicity, "toxic", "drop_toxic")])
def test_classifiers(spark, docs, module, label, drop):
    folder = "/root/testdata/sf0.1"
    table, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = module.train(table, labels, 3000)
    truth = {r.doc_id: r[label] for r in labels.collect()}
    scored = [r for r in module.with_scores(table, model, keep=["doc_id"]).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 == 0]
    known = [(r.predicted, truth[r.doc_id]) for r in scored if truth.get(r.doc_id) is not None]
    assert len(known) > 100
    assert sum(a == b for a, b in known) / len(known) > 0.95
    assert all(0 <= r.score <= 1 for r in scored)

    rows = module.with_scores(docs, model).collect()
    assert len(rows) == docs.count() and rows[0].N_Words == "old"
    by_text = {}
    for row in rows:
        assert by_text.setdefault(row.text or "", row.score) == row.score
    kept = getattr(module, drop)(docs, model)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted == (label == "quality") for r in rows)
    assert module.with_scores(empty(spark), model).count() == 0


@pytest.mark.parametrize("module, label", [(quality_ranking, "quality"), (toxicity, "toxic")])
def test_classifiers_without_labels(spark, docs, module, label):
    none = spark.createDataFrame([], f"doc_id long, {label} int")
    rows = module.with_scores(docs, module.train(docs, none)).collect()
    assert all(0 <= r.score <= 1 for r in rows)


# --- 9: quality rules --------------------------------------------------------


def test_measures_equal_brute_force(spark, docs):
    for row in quality_rules.with_measures(docs).collect():
        text = row.text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(zip(words, words[1:], words[2:]))
        repeated = {p for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for p in range(i, i + 3)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert row.n_words == len(words)
        assert row.word_chars == sum(map(len, words))
        assert row.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert row.n_dup_lines == len(lines) - len(set(lines))
        assert row.n_repeat_words == len(repeated)
        assert row.base_failed == (len(words) < 50 or 100 * len(repeated) > 50 * len(words))


def test_rules_adapt_to_each_group(spark):
    texts = [" ".join(f"w{n}x{i}" for i in range(80)) for n in range(60)] + [" ".join(f"w{i}" + "#" * 9 for i in range(80))]
    docs = spark.createDataFrame([(n, t, "en", "web", "old") for n, t in enumerate(texts)], "doc_id long, text string, lang string, source string, kept string")
    kept = {r.doc_id: r.kept for r in quality_rules.apply_rules(quality_rules.with_measures(docs)).collect()}
    assert [n for n, ok in kept.items() if not ok] == [60]
    assert len(kept) == 61


def _bin(value):
    drop = max(value.bit_length() - quality_rules.BITS, 0)
    return value >> drop << drop


def test_limits_equal_brute_force(spark):
    """Groups large enough by themselves, through their language and through the whole corpus only."""
    rng = np.random.default_rng(5)
    rows = []
    for lang, source, n, width in (("en", "web", 400, 4), ("en", None, 30, 9), ("de", "web", 20, 6), (None, "a", 15, 5)):
        for _ in range(n):
            words = ["x" * int(rng.integers(1, 2 * width)) + "#" * int(rng.random() < rng.random() / 4) for _ in range(int(rng.integers(40, 130)))]
            lines = [" ".join(words[i : i + 10]) for i in range(0, len(words), 10)]
            rows.append((len(rows), "\n".join(lines + lines[: int(rng.integers(0, 2))]), lang, source))
    planted = range(len(rows), len(rows) + 3)
    rows += [(n, " ".join(f"##a{i}" for i in range(60)), "en", "web") for n in planted]
    measured = quality_rules.with_measures(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"))
    got = {r.doc_id: r for r in quality_rules.apply_rules(measured).collect()}
    passing = [r for r in got.values() if not r.base_failed]
    binned = lambda r, m: _bin(r[m] * 1000 // max(r.n_words, 1))

    def judged(accepted):
        out, found = set(), {}
        for row in passing:
            own = (row.lang, row.source)
            if own not in found:
                wider = [[r for r in accepted if (r.lang, r.source) == own], [r for r in accepted if r.lang == row.lang]]
                chosen = next((g for g in wider if len(g) >= quality_rules.MIN_DOCS), accepted)
                found[own] = {}
                for measure in quality_rules.MEASURES:
                    values = sorted(binned(r, measure) for r in chosen)
                    q = {k: values[-(-len(values) * k // 100) - 1] for k in (1, 25, 50, 75, 99)}
                    width = quality_rules.FENCE * (q[75] - q[25])
                    found[own][measure] = (q[25] - width, q[75] + width) if width else (2 * q[1] - q[50], 2 * q[99] - q[50])
            if all(low <= binned(row, m) <= high for m, (low, high) in found[own].items()):
                out.add(row.doc_id)
        return out

    first = judged(passing)
    kept = judged([r for r in passing if r.doc_id in first])
    assert {n for n, r in got.items() if r.kept} == kept
    by_sketch = len(passing) - len(kept)
    assert not any(got[n].kept for n in planted)
    assert by_sketch >= len(planted)
    assert len({tuple(r) for r in quality_rules.group_limits(measured, ["lang", "source"]).select("_docs").collect()}) == 3
    assert quality_rules.group_limits(measured, []).count() == 1


def test_rules_judge_a_wholly_rejected_group_by_those_around_it(spark):
    clean = [(n, " ".join(f"w{n}x{i:0{2 + (n + i) % 5}}" for i in range(80)), "en", "web") for n in range(150)]
    odd = [(150 + n, " ".join(f"{'#' * 9}{n}x{i}" for i in range(80)), "xx", "odd") for n in range(3)]
    docs = spark.createDataFrame(clean + odd, "doc_id long, text string, lang string, source string")
    rows = quality_rules.apply_rules(quality_rules.with_measures(docs)).collect()
    assert len(rows) == 153
    assert {r.doc_id for r in rows if not r.kept} == {150, 151, 152}


def test_rules_on_awkward_and_empty_tables(spark, docs):
    rows = quality_rules.apply_rules(quality_rules.with_measures(docs)).collect()
    assert len(rows) == docs.count()
    assert not any(r.kept for r in rows if r.base_failed)
    assert quality_rules.apply_rules(quality_rules.with_measures(empty(spark))).count() == 0


