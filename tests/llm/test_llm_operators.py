"""The numbered operators against brute force, and on odd rows."""

from __future__ import annotations

import hashlib
import html
import math
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import xxhash

from quarryline.llm import byte_bpe, html_text, language_id, near_copies, packing, quality, sharding, simhash, topk_search, url_filter
from quarryline.llm.common import connected_components
from quarryline.llm.embedding_dedup import near_duplicates
from quarryline.llm.topk_search import top_k

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, key string, value string"


def documents(spark, rows):
    """Rows (doc_id, text, source) as documents with two more columns of clashing names."""
    full = [(i, t, "en", s, None if t is None else len(t), "k", "v") for i, t, s in rows]
    return spark.createDataFrame(full, DOCUMENTS)


ODD = [(1, None, None), (2, "", "a"), (2, "", "a"), (None, "one two", "a"), (5, "x" * 50_000, "b"), (6, "y z " * 9000, "a")]


def closure(ids, linked):
    label = dict(zip(range(len(ids)), ids))
    changed = True
    while changed:
        changed = False
        for i in range(len(ids)):
            for j in range(len(ids)):
                if linked(i, j) and label[i] != label[j]:
                    label[i] = label[j] = min(label[i], label[j])
                    changed = True
    return [label[i] for i in range(len(ids))]


def test_components_of_chains_stars_and_loops(spark):
    chain = [(f"c{i:03}", f"c{i + 1:03}") for i in range(40)]
    star = [("s00", f"s{i:02}") for i in range(1, 30)]
    edges = spark.createDataFrame([*chain, *star, ("x", "x"), ("c001", "c000"), (None, "q")], "a string, b string")
    found = {r["node"]: r["root"] for r in connected_components(edges).collect()}
    assert found == {**{f"c{i:03}": "c000" for i in range(41)}, **{f"s{i:02}": "s00" for i in range(30)}}
    assert connected_components(edges.limit(0)).count() == 0


# 1


def test_embedding_links_match_brute_force(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(60, 16))
    near = np.concatenate([base[i % 20] + rng.normal(scale=0.12, size=(1, 16)) for i in range(120)])
    x = np.concatenate([base, near, base[:3]])
    rows = [(i, [float(v) for v in vector], 0) for i, vector in enumerate(x)]
    odd = [(900, None, 1), (901, [0.0] * 16, 1), (902, [float("nan")] + [1.0] * 15, 1), (903, [None] + [1.0] * 15, 1), (904, [], 1), (905, [1.0, 2.0], 1)]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: r for r in near_duplicates(frame, leaf_sample=12).collect()}
    assert len(found) == len(rows) + len(odd)
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near_pairs = unit @ unit.T >= 0.9
    np.fill_diagonal(near_pairs, False)
    true = near_pairs.sum(axis=1)
    links = np.array([found[i]["n_links"] for i in range(len(x))])
    assert (links <= true).all() and links.sum() >= 0.95 * true.sum()
    labels = closure(list(range(len(x))), lambda i, j: near_pairs[i, j])
    assert np.mean([found[i]["component_id"] == labels[i] for i in range(len(x))]) > 0.97
    for key, _, _ in odd:
        assert (found[key]["n_links"], found[key]["component_id"], found[key]["kept"]) == (0, key, True)
    assert near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("tile_rows", [8192, 300])
def test_links_of_a_group_that_holds_a_third(spark, tile_rows):
    rng = np.random.default_rng(8)
    centre = rng.normal(size=64)
    group = centre / np.linalg.norm(centre) + rng.normal(scale=0.0315, size=(1500, 64))
    # Some are linked with part of the group only, most with nothing.
    rim = centre / np.linalg.norm(centre) + rng.normal(scale=0.05, size=(40, 64))
    x = np.concatenate([group, rim, rng.normal(size=(2960, 64))])
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r for r in near_duplicates(frame, tile_rows=tile_rows).collect()}
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    links = np.array([found[i]["n_links"] for i in range(len(x))])
    assert (links <= near.sum(axis=1)).all() and links.sum() >= 0.999 * near.sum()
    assert {found[i]["component_id"] for i in range(1500)} == {0}


# 2


def test_encoding_is_that_of_the_tokenizer():
    ranks = byte_bpe.read_ranks(RANKS)
    encoder = byte_bpe.Encoder(ranks, public_tokenizers.PATTERN)
    truth = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rng = random.Random(5)
    parts = ["a", " ", "  ", "\n", "'s", "the ", "ß", "漢", "😀", "\x1c", "\xa0", "١", "zu", "...", "<|endoftext|>"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 20))) for _ in range(1500)] + ["ab" * 20_000, " " * 3000]
    for text in texts:
        packed = encoder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == truth.encode_ordinary(text)
        assert encoder.decode(packed) == text.encode()


def test_prefix_table_appends_and_edits():
    vocabulary = byte_bpe.Vocabulary(byte_bpe.read_ranks(RANKS))
    whole = lambda piece: byte_bpe.PrefixTable(vocabulary, piece).ids()
    table = byte_bpe.PrefixTable(vocabulary, b"inter")
    table.append(b"nationalisation")
    assert table.ids() == whole(b"internationalisation")
    assert table.ids(5) == whole(b"inter")
    table.edit(5, 13, b"act")
    assert table.ids() == whole(table.piece)


def test_encode_and_decode_frames(spark):
    frame = documents(spark, ODD)
    done = byte_bpe.digests(frame, RANKS, public_tokenizers.PATTERN)
    empty = hashlib.sha256(b"").hexdigest()
    by_id = {r["doc_id"]: r for r in done.collect()}
    assert done.count() == len(ODD)
    assert tuple(by_id[1]) == (1, 0, empty, empty)
    assert by_id[5]["decoded_sha256"] == hashlib.sha256(b"x" * 50_000).hexdigest()
    back = byte_bpe.decode(byte_bpe.encode(frame, RANKS, public_tokenizers.PATTERN), RANKS)
    assert sorted(bytes(r["bytes"]) for r in back.collect()) == sorted((t or "").encode() for _, t, _ in ODD)
    assert byte_bpe.digests(frame.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


# 3


def test_blocks_travel_along_aliases(spark):
    link = '<html><head><LINK href="{}" rel=canonical></head>'
    move = '<meta http-equiv="refresh" content="0; url={}">'
    pages = spark.createDataFrame(
        [
            (1, "https://a.org/x#top", link.format("http://bad.net/es/1"), "k"),
            (2, "https://b.org/y", move.format("https://A.org/x"), "k"),
            (3, "https://c.org/z", link.format("/w"), "k"),
            (4, "https://c.org/w", move.format("http://bad.net/fr/2"), "k"),
            (5, "https://c.org/v", link.format("https://c.org/w"), "k"),
            (6, "https://ok.com/p", move.format("https://c.org/v"), "k"),
            (7, "http://x.example.com/en/1", None, "k"),
            (8, "http://q.www.EXAMPLE.com/en/1?x", "", "k"),
            (9, None, "<p>", "k"),
            (10, "no scheme", None, "k"),
            (10, "http://net", None, "k"),
        ],
        "page_id long, url string, html string, node string",
    )
    from quarryline.llm.queries import URL_RULES

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    done = [tuple(r) for r in url_filter.url_verdicts(pages, rules).select("page_id", "host", "path", "rule", "verdict").collect()]
    assert len(done) == 11
    verdicts = {(r[0], r[1]): r[3:] for r in done}
    assert verdicts[1, "a.org"] == (None, "block") and verdicts[2, "b.org"] == (None, "block")
    assert verdicts[4, "c.org"] == verdicts[5, "c.org"] == (None, "allow")  # one alias is allowed by rule
    assert verdicts[7, "x.example.com"] == ("example.com/en/", "block")
    assert verdicts[8, "q.www.example.com"] == ("www.example.com/en/", "allow")
    assert verdicts[9, ""] == (None, "allow") and verdicts[10, "net"] == (None, "allow")
    assert url_filter.url_verdicts(pages.limit(0), rules).count() == 0


# 4


@pytest.mark.parametrize("scale", [0.4, 1e6])
def test_top_k_is_exact(spark, scale):
    rng = np.random.default_rng(1)
    x = np.round(rng.normal(scale=scale, size=(300, 7)), 2)
    x[40:60] = x[3]
    rows = [(i, [float(v) for v in vector]) for i, vector in enumerate(x)]
    odd = [(700, None), (750, [float("inf")] * 7), (None, [1.0] * 7), (800, [1.0])]
    frame = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>")
    from pyspark.sql import functions as F

    found = top_k(frame, F.col("vec_id") % 50 == 0, k=4, block_rows=64, query_chunk=3)
    integers = [[math.floor(256 * v) for v in vector] for vector in x.tolist()]
    expected = []
    for q in range(0, 300, 50):
        scores = [(-sum(a * b for a, b in zip(integers[q], v)), i) for i, v in enumerate(integers) if i != q]
        expected += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(scores)[:4])]
    assert sorted(tuple(r) for r in found.collect()) == expected
    assert top_k(frame.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_slices_hold_the_exact_score():
    rng = np.random.default_rng(2)
    values, queries = rng.integers(-300, 300, (130, 5)), rng.integers(-300, 300, (9, 5))
    block = topk_search.Block(values, slices=3)
    total, error = block.scores(queries)
    exact = values @ queries.T
    for q in range(9):
        bits = [np.unpackbits(plane[q].view(np.uint8), bitorder="little")[:130] for plane in total]
        coarse = sum(b.astype(np.int64) << i for i, b in enumerate(bits)) << block.drop
        hidden = exact[:, q] - coarse
        assert hidden.max() - hidden.min() <= error[q]


# 5


def test_gradients_of_the_network():
    model = language_id.BiGRU(["a", "b", "c"], hidden=3)
    model.w = {name: value.astype(np.float64) for name, value in model.w.items()}
    codes, truth = language_id._codes([b"abca", b"xyzx"]), np.array([0, 2])
    _, grads = model.gradients(codes, truth)
    for name, place in (("uf", (1, 2)), ("cb", (0, 1)), ("xf", (98, 4)), ("of", (2, 1)), ("ub", (2, 5))):
        kept, losses = model.w[name][place], []
        for step in (1e-3, -1e-3):
            model.w[name][place] = kept + step
            losses.append(model.gradients(codes, truth)[0])
        model.w[name][place] = kept
        assert (losses[0] - losses[1]) / 2e-3 == pytest.approx(grads[name][place], rel=0.05, abs=2e-4)


def test_language_of_held_out_documents(spark, sf_dir):
    frame = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = language_id.train(frame)
    done = language_id.predict(frame, model).where("held_out").join(frame, "doc_id")
    total, right = done.count(), done.where("lang = lang_pred").count()
    assert right >= 0.95 * total
    odd = {(r["doc_id"], r["lang_pred"]) for r in language_id.predict(documents(spark, [*ODD, (9, "12 . ?", "a")]), model).collect()}
    assert {(1, "und"), (2, "und"), (9, "und")} <= odd
    assert language_id.train(frame.limit(0)) is None
    assert language_id.predict(frame.limit(0), model).count() == 0


# 6


def test_every_piece_is_in_the_tightest_compatible_bin():
    rng = random.Random(4)
    pieces = sorted(((rng.randint(0, 50), rng.choice([None, 0, 0, 1, 2]), rng.choice([None, *range(9)])) for _ in range(400)), key=lambda p: -p[0])
    placed = packing.pack(pieces, 50)
    rooms, members = {}, {}
    for (size, source, cluster), target in zip(pieces, placed):
        open_ = [
            (room, b) for b, room in rooms.items()
            if room >= size and not any((s is not None and s == source) or (c is not None and c == cluster) for s, c in members[b])
        ]
        assert target == (min(open_)[1] if open_ else len(rooms))
        rooms[target] = rooms.get(target, 50) - size
        members.setdefault(target, []).append((source, cluster))


def test_packing_keeps_all_text_and_all_conflicts(spark):
    rows = [*ODD, *[(100 + i, f"text {i % 7} " * (i % 11), "hot" if i % 3 else f"s{i}") for i in range(200)]]
    done = packing.best_fit(documents(spark, rows), capacity=64, part_pieces=50).collect()
    assert sum(r["size"] for r in done) == sum(len(t or "") for _, t, _ in rows)
    bins = {}
    for r in done:
        bins.setdefault(r["bin_id"], []).append(r)
    for members in bins.values():
        assert sum(r["size"] for r in members) <= 64
        for column in ("source", "cluster"):
            values = [r[column] for r in members if r[column] is not None]
            assert len(values) == len(set(values))
    assert len({(r["doc_id"], r["piece"]) for r in done if r["doc_id"] and r["doc_id"] > 2}) == len([r for r in done if r["doc_id"] and r["doc_id"] > 2])
    assert packing.best_fit(documents(spark, []), capacity=64).count() == 0


# 7


def test_gradients_of_attention():
    rng = np.random.default_rng(0)
    model = quality.AttentionMIL()
    x, counts, truth = rng.normal(size=(7, quality.FEATURES)), np.array([3, 1, 3]), np.array([1.0, 0.0, 1.0])
    _, grads = model.gradients(x, counts, truth)
    for name, place in (("e", (2, 3)), ("v", (1, 2)), ("u", (0, 4)), ("a", (3,)), ("s", (5,)), ("eb", (1,))):
        kept, losses = model.w[name][place], []
        for step in (1e-5, -1e-5):
            model.w[name][place] = kept + step
            losses.append(model.gradients(x, counts, truth)[0])
        model.w[name][place] = kept
        assert (losses[0] - losses[1]) / 2e-5 == pytest.approx(grads[name][place], rel=1e-3, abs=1e-8)


def test_quality_of_held_out_documents(spark, sf_dir):
    folder = sf_dir.replace("sf0.001", "sf0.01")
    frame, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    model = quality.train(frame, labels)
    done = quality.score(frame, model)
    held = done.where("held_out").join(labels, "doc_id")
    assert held.where("predicted = quality").count() >= 0.9 * held.count()
    odd = quality.score(documents(spark, ODD), model).collect()
    assert len(odd) == len(ODD) and all(0 <= r["score"] <= 1 for r in odd)
    assert quality.train(frame, labels.limit(0)) is None
    assert quality.score(frame.limit(0), model).count() == 0


# 8


def test_only_large_buckets_split(spark):
    rng = random.Random(8)
    rows = [(i, "w" * rng.randint(0, 60), "s") for i in range(600)] + [(7, "hot " * 10, "s")] * 500 + ODD
    done = sharding.assign(documents(spark, rows), limit=400).collect()
    assert len(done) == len(rows)
    shards = {r["shard"]: r for r in done}
    names = sorted(shards)
    assert not any(b.startswith(a) for a, b in zip(names, names[1:]))
    for name, r in shards.items():
        assert r["depth"] == len(name)
        assert r["shard_bytes"] <= 400 or r["shard_rows"] == 1
        above = [x for x in shards if x.startswith(name[:-1])]
        assert sum(shards[x]["shard_bytes"] for x in above) > 400
    assert sum(r["shard_bytes"] for r in shards.values()) == sum(len(t or "") for _, t, _ in rows)
    assert {r["shard"] for r in sharding.assign(documents(spark, ODD[:4])).collect()} == {""}
    assert sharding.assign(documents(spark, [])).count() == 0


def test_written_shards_hold_null_and_repeated_keys(spark, tmp_path):
    frame = documents(spark, [(i, f"text {i}", "s") for i in range(40)] + [(7, f"again {i}", "s") for i in range(20)] + [(None, "none", "s")] * 2)
    sharding.write_shards(frame, str(tmp_path / "shards"), limit=100)
    written = spark.read.parquet(str(tmp_path / "shards"))
    assert sorted(map(repr, written.select(*frame.columns).collect())) == sorted(map(repr, frame.collect()))
    assert written.select("shard").distinct().count() > 1


# 9


def test_main_text_of_pages(spark):
    page = (
        "<!doctype html><html><head><title>T</title><script>if (a<b) x='</p>'</script></head><body><nav><ul><li>Home</ul></nav>"
        "<div class='cookie-notice'>We use cookies</div><aside>Side</aside><form><p>Name</form><article><h1>Head &amp; tail</h1>"
        "<p>First  <b>block</b>\n of it<br>second<div class=ad>Buy</div><p>Last &#233;nd.</article>"
        "<section id='comments'><p>" + "Nice! " * 60 + "</p></section><footer>&copy; x</footer>"
    )
    assert html_text.main_text(page) == "Head & tail First block of it second Last énd."
    assert html_text.main_text("<p>" + "long " * 40 + "</p><!-- x --><div hidden>no</div>") == ("long " * 40).strip()
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<nav>x</nav>"), (4, "u", "plain " * 30_000), (4, "u", "<p>a")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    done = html_text.extract(pages)
    assert sorted(r["n_chars"] for r in done.collect()) == [0, 0, 0, 1, 179_999]
    assert html_text.extract(pages.limit(0)).count() == 0


def test_text_beside_a_teaser_and_short_paragraphs_stay():
    long, short = "The text of this page goes on for some time. " * 4, "A short paragraph."
    teaser = "<article><h2>More</h2></article>"
    words = f"{long.strip()} {short}"
    assert words in html_text.main_text(f"<body>{teaser}<div>{long}</div><div>{short}</div></body>")
    advert = "<div class=ad>Buy</div>"
    for page in (
        f"<body><p>{long}</p>{advert}<p>{short}</p></body>",
        f"<body><div>Top</div>{advert}<div><p>{long}</p>{advert}<p>{short}</p></div>{advert}<div>Bottom</div></body>",
        f"<div><div>Top</div></div>{advert}<div><div>{long}</div>{advert}<div>{short}</div></div>",
    ):
        assert html_text.main_text(page) == words
    between = f"<div>{long}</div>{advert}<div>{short}</div>{advert}<div>{long}</div>"
    assert html_text.main_text(between) == f"{words} {long.strip()}"
    # The article wins where nothing else surges; where its text is next to nothing, the distribution decides.
    assert html_text.main_text(f"<article><p>{short} {short}</p>{advert}<p>End.</p></article>{advert}<div>{long[:80]}</div>") == f"{short} {short} End."
    assert html_text.main_text(f"<article>x</article>{advert}<div>{long}</div>") == long.strip()


def test_given_pages_keep_their_articles(spark, sf_dir):
    import re

    for r in html_text.extract(spark.read.parquet(f"{sf_dir}/pages.parquet")).join(spark.read.parquet(f"{sf_dir}/pages.parquet"), "page_id").collect():
        article = re.search(r"<article>(.*?)</article>", r["html"], re.S).group(1)
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1|br)>", article)]
        assert r["text"] == " ".join(b for b in blocks if b)


# 10


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", words) if w]
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprints_and_components(spark):
    rng = random.Random(10)
    base = [rng.choice("alpha Beta gamma delta eps zeta eta theta".split()) for _ in range(120)]
    rows = list(ODD)
    for i in range(60):
        words = list(base)
        for _ in range(i % 4):
            words[rng.randrange(120)] = f"w{i}"
        rows.append((10 + i, " ".join(words), "s"))
    frame = documents(spark, rows)
    prints = [plain_fingerprint(t) for _, t, _ in rows]
    ids = [10**9 if i is None else i for i, _, _ in rows]
    labels = closure(ids, lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 3)
    found = simhash.simhash_components(frame).collect()
    expected = sorted((i if i != 10**9 else -1, f"{p:016x}", c if c != 10**9 else -1) for i, p, c in zip(ids, prints, labels))
    assert sorted((-1 if r[0] is None else r[0], r[1], -1 if r[2] is None else r[2]) for r in found) == expected
    kept = simhash.one_of_each(frame)
    assert kept.columns == frame.columns and kept.count() == len(set(labels))
    assert simhash.simhash_components(frame.limit(0)).count() == 0


def test_tiled_shards_connect_the_same(spark):
    rng = random.Random(3)
    base = rng.getrandbits(63)
    values = {base} | {base ^ (1 << rng.randrange(60)) ^ (1 << rng.randrange(60)) for _ in range(150)}
    frame = spark.createDataFrame([(v,) for v in values], "fingerprint long")
    for shard_rows in (16, 4096):
        roots = connected_components(simhash.near_links(frame, shard_rows=shard_rows)).collect()
        assert {r["root"] for r in roots} == {min(values)} and len(roots) == len(values)


def test_near_copies_of_similarity_go(spark):
    source = random.Random(8)
    words = [f"w{i}" for i in range(4000)]
    rows, groups = [], 60
    for group in range(groups):
        text = source.choices(words, k=source.choice([60, 200, 900]))
        for copy in range(source.choice([1, 2, 5])):
            own = list(text)
            # One edit takes five shingles; similarity stays at 0.8 or more.
            for _ in range(min(copy, len(own) // 60)):
                own[source.randrange(len(own))] = f"edit{group}-{copy}"
            rows.append((group * 10 + copy, " ".join(own), "a"))
    rows += [(10_000, None, None), (10_001, "", "a"), (10_001, " \t", "a"), (None, rows[0][1], "b"), (10_002, "a b", "a"), (10_003, "A  b", "a")]
    rows += rows[:5] + [(10_004, "long " + " ".join(source.choices(words, k=60_000)), "a")]
    frame = documents(spark, rows)
    kept = near_copies.one_of_each(frame)
    assert kept.columns == frame.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [g * 10 for g in range(groups)] + [10_000, 10_002, 10_004]
    assert near_copies.one_of_each(frame.limit(0)).count() == 0


@pytest.mark.parametrize("shard_rows", [4, 2048])
def test_near_copies_end_at_the_border(spark, shard_rows):
    source = random.Random(21)
    rows = []
    for group in range(40):
        text = [f"g{group}w{i}" for i in range(source.choice([8, 9, 30, 60, 240]))]
        for _ in range(6):
            own = text[: len(text) - source.choice([0, 0, 1, 2])]
            for _ in range(source.choice([0, 1, 1, 2, max(1, len(own) // 50)])):
                own[source.randrange(len(own))] = f"edit{len(rows)}"
            rows.append((len(rows), " ".join(own), "a"))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(len(t.split()) - 4)} for _, t, _ in rows]
    labels = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8 and labels[a] != labels[b]:
                labels = [min(labels[a], labels[b]) if x in (labels[a], labels[b]) else x for x in labels]
    kept = near_copies.one_of_each(documents(spark, rows), shard_rows=shard_rows)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(labels))


def test_tree_search_is_complete():
    rng = random.Random(1)
    tree, values = simhash.BKTree(), [rng.getrandbits(10) for _ in range(300)]
    for value in values:
        tree.add(value)
    for query in range(0, 1024, 37):
        assert {tree.values[i] for i in tree.within(query, 2)} == {v for v in values if (v ^ query).bit_count() <= 2}


def test_large_keys_beside_null_keys(spark):
    big = 2**53 + 1  # no floating point number
    rows = [(None, "ab cd", "s"), (big, "ab cd", "t"), (big + 2, "xy zz", "t")]
    frame, keys = documents(spark, rows).coalesce(1), {None, big, big + 2}
    vectors = spark.createDataFrame([(key, [1.0, 0.0]) for key in keys], "vec_id long, embedding array<double>").coalesce(1)
    pages = spark.createDataFrame([(key, "u", "<p>a</p>") for key in keys], "page_id long, url string, html string").coalesce(1)
    done = [
        byte_bpe.digests(frame, RANKS, public_tokenizers.PATTERN),
        byte_bpe.encode(frame, RANKS, public_tokenizers.PATTERN),
        byte_bpe.decode(byte_bpe.encode(frame, RANKS, public_tokenizers.PATTERN), RANKS),
        language_id.predict(frame, language_id.train(frame)),
        packing.best_fit(frame),
        near_duplicates(vectors),
        html_text.extract(pages),
        near_copies.one_of_each(frame.where("doc_id is null or source = 't'")).unionByName(frame.where("doc_id is null")),
    ]
    for result in done:
        assert {r[0] for r in result.collect()} == keys, result.columns
