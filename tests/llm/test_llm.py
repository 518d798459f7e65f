"""The training-data operators against brute force, on small tables with nulls, empty and repeated rows and clashing names."""

from __future__ import annotations

import hashlib
import html
import itertools
import re
import time
import zlib
from collections import Counter, defaultdict
from datetime import datetime

import numpy as np
import pyarrow.parquet as pq
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from murmuro import runtime
from murmuro.llm import (
    catalog,
    decontaminate,
    imatch,
    jaccard_join,
    line_dedup,
    mixing,
    pseudonyms,
    style_tree,
    token_files,
    toxicity,
    url_filter,
    words,
)

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, row bigint, pattern string, copies string"
WORD = re.compile(r"\w+")

LONG = " ".join(f"w{i % 977}x{i * i % 1009}" for i in range(30_000))
COMMON = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen"
MESSY = [
    (1, COMMON + "\nA line of its own that nobody else has.", "a"),
    (2, "Something before this.\n" + COMMON + "\nAnd after it more words than that.", "a"),
    (3, COMMON + "\nA line of its own that nobody else has.", "b"),
    (3, COMMON + "\nA line of its own that nobody else has.", "b"),
    (4, None, None),
    (5, "", "b"),
    (6, "short", "a"),
    (7, LONG, "c"),
    (None, "No id but words enough to be told from all the others here", "c"),
    (None, None, "c"),
    (8, "one, TWO three! café ½ 1234 日本", ""),
    (9, " \n \n", "a"),
]


@pytest.fixture(scope="module")
def messy(spark):
    rows = [(i, t, "en", s, 0 if t is None else len(t), 5, "p", "c") for i, t, s in MESSY]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df):
    return {r.doc_id: r.text or "" for r in df.collect()}


@pytest.mark.parametrize("text", ["ab1" * 350_000, "a@b" + ".c" * 500_000, "7" * 1_000_000, "1." * 500_000, "." * 1_000_000, "x@" * 500_000])
def test_pseudonyms_of_a_long_run_take_seconds(spark, text):
    start = time.monotonic()
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert pseudonyms.pseudonymised(df, "k").collect()[0].text == text
    assert time.monotonic() - start < 30


def test_pseudonyms_of_names_that_touch(spark):
    texts = ["a@b.com.c@d.com", "x foo@bar@baz.com", "..ab@c.de!", "éz@q.de", "x" * 300 + "@mail.com"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r.doc_id: (r.n_found, r.text) for r in pseudonyms.pseudonymised(df, "k").collect()}
    assert [got[i][0] for i in range(5)] == [2, 1, 1, 1, 0]
    assert re.fullmatch(r"\w@b\.com\.\w@d\.com", got[0][1]) and re.fullmatch(r"x foo@\w{3}@baz\.com", got[1][1])
    assert got[2][1].startswith("..") and got[4][1] == texts[4]


def test_the_sample_does_not_follow_file_order(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_FEATURES", 2_000)
    rows = [(i, f"word{i % 7} " * (5 + i % 3) + ("vile scum " if i % 4 == 0 else "fine day ") + f"extra{i}") for i in range(200)]
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i, _ in rows], "doc_id bigint, quality int, toxic int")
    one, other = (
        toxicity.train(spark.createDataFrame(r, "doc_id bigint, text string").repartition(n), labels) for r, n in ((rows, 1), (rows[::-1], 3))
    )
    assert one.threshold == other.threshold and all((a == b).all() for a, b in zip(one.weights, other.weights, strict=True))


def test_open_tags_take_linear_time():
    start = time.monotonic()
    assert list(style_tree.blocks("<b>" * 100_000 + "<div></div>" * 100_000)) == []
    assert sum(1 for _ in style_tree.blocks("<p>x" * 100_000 + "</i></b>" * 100_000)) == 100_000
    assert time.monotonic() - start < 20


def test_names_inside_an_article_drop_no_text():
    page = (
        '<article><div class="share-prices-table">a</div><p class="respond">b</p><fieldset><legend>c</legend>d</fieldset>'
        '<div class="share-buttons">no</div><form>no<fieldset>no</fieldset></form><div class="post-content related-topics">e</div></article>'
    )
    assert [b[3] for b in style_tree.blocks(page)] == ["a", "b", "c", "d", "e"]


def test_a_stage_removes_what_the_one_before_wrote(spark, documents, tmp_path):
    catalog.forget_stage(spark, documents)
    app = spark.sparkContext.applicationId
    first = catalog.keep_one_of_each(spark, documents, SF)
    noted = list(catalog._WRITTEN[app])
    assert noted and all(runtime.exists_folder(spark, p) for p in noted)
    # Handed on without being written, a stage keeps the tables it still reads.
    second = catalog.keep_uncontaminated(spark, first, SF)
    n = second.count()
    second.write.parquet(str(tmp_path / "second"))
    third = catalog.mix_sources(spark, spark.read.parquet(str(tmp_path / "second")), SF)
    assert third.count() > 0 and 0 < n <= documents.count()
    assert not any(runtime.exists_folder(spark, p) for p in noted)


def test_pieces_keep_every_word(monkeypatch):
    monkeypatch.setattr(words, "PIECE", 10)
    text = "aa bbb\ncccccccccccccccccccccc d e ff " * 5
    assert WORD.findall(text) == [w for p in words.pieces(text) for w in WORD.findall(p)]
    assert list(words.pieces("")) == [""]


# 1 toxicity


def test_toxicity_finds_held_out_documents(spark, documents):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    train = labels.where("doc_id % 3 != 0")
    models = toxicity.train(docs, train)
    rows = toxicity.scores(docs, models).join(labels.select("doc_id", F.col("toxic").alias("label")), "doc_id").collect()
    held = [r for r in rows if r.doc_id % 3 == 0]
    assert len(rows) == labels.count()
    assert sum(r.toxic for r in held if r.label) >= 0.8 * sum(r.label for r in held)
    assert sum(r.toxic for r in held if not r.label) <= 0.02 * len(held)


def test_toxicity_of_odd_tables(spark, messy, nothing):
    labels = spark.createDataFrame([(1, 1, 1), (2, 1, 0), (2, 1, 0), (None, 0, 1), (99, 0, 1), (6, None, None)], "doc_id bigint, quality int, toxic int")
    models = toxicity.train(messy, labels)
    assert toxicity.scores(messy, models).count() == len(MESSY)
    assert toxicity.accepted(messy, models).columns == messy.columns
    assert toxicity.scores(nothing, models).count() == 0
    none = toxicity.train(nothing, labels)
    assert toxicity.accepted(messy, none).count() == len(MESSY)


def test_chain_uses_out_of_fold_probabilities():
    rng = np.random.default_rng(1)
    n, width = 300, 40
    numbers = np.concatenate([rng.choice(width, 5, replace=False) for _ in range(n)]).astype(np.int32)
    x = toxicity.Examples(numbers, np.ones(5 * n, np.float32), np.full(n, 5))
    first = np.asarray([(numbers[5 * i : 5 * i + 5] < 8).any() for i in range(n)], float)
    y = np.column_stack([first, first])
    (one, two), _ = toxicity.chained(x, y, np.arange(n) % toxicity.FOLDS)
    assert len(two) == len(one) + 1 and two[-2] > 0.5  # the second model leans on the first one's probability


# 2 pseudonyms


def _luhn(digits):
    return sum(sum(divmod(int(d) * (2 if i % 2 else 1), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def test_pseudonyms_keep_format_and_links(spark):
    values = [
        "4018709761430345", "4018-7097-6143-0345", "4018709761430346", "+1 (348) 555-6390", "94.240.51.71", "1.2.3.444",
        "2024-02-29", "2023-02-29", "31.12.1999", "12/31/1999", "31/12/1999", "jane.doe9@mail.example.com",
        "DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "123-45-6789", "000-45-6789", "+44 20 7946 0958",
    ]
    rows = [(i, f"start {v} and {v}, end") for i, v in enumerate(values)] + [(50, None), (51, ""), (None, "4018709761430345")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("found", F.lit(1))
    out = {r.doc_id: r for r in pseudonyms.pseudonymised(df, "k").collect()}
    got = {v: re.fullmatch(r"start (.*) and \1, end", out[i].text)[1] for i, v in enumerate(values)}
    for v in ("4018709761430346", "1.2.3.444", "2023-02-29", "000-45-6789"):
        assert got[v] == v
    for v, new in got.items():
        assert re.sub(r"\d", "9", v) == re.sub(r"\d", "9", new) or "." in v and v.count(".") == 3
    changed = [v for v in values if got[v] != v]
    assert len(changed) == len(values) - 4
    card = got["4018709761430345"]
    assert _luhn(card) and card[0] == "4" and got["4018-7097-6143-0345"].replace("-", "") == card == out[None].text
    assert all(0 <= int(x) < 256 for x in got["94.240.51.71"].split("."))
    day = datetime.strptime(got["31.12.1999"], "%d.%m.%Y")
    assert day == datetime.strptime(got["12/31/1999"], "%m/%d/%Y") == datetime.strptime(got["31/12/1999"], "%d/%m/%Y")
    iban = got["DE89370400440532013000"]
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    assert got["DE89 3704 0044 0532 0130 00"].replace(" ", "") == iban
    assert got["jane.doe9@mail.example.com"].endswith("@mail.example.com")
    assert out[50].text is None and out[51].text == "" and out[50].n_found == 0
    assert pseudonyms.pseudonymised(df.where("false"), "k").count() == 0
    plan = pseudonyms.pseudonymised(df, "k")._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_pseudonyms_of_odd_shapes(spark):
    phones = ["+1 (017) 555-7713", "+1 (132) 555-1352", "+1 212 055 1234", "+12125550199", "(117) 555-7713"]
    dates = {"3.4.2024": "%d.%m.%Y", "4/3/2024": "%m/%d/%Y", "2024-4-3": "%Y-%m-%d"}
    values = [*phones, *dates, "a@b.org", "7@b.org"]
    rows = [(i, f"start {v} end") for i, v in enumerate(values)] + [(50, "at 2024-04-03T10:00:00Z"), (51, "at 2024-04-03")]
    out = {r.doc_id: r for r in pseudonyms.pseudonymised(spark.createDataFrame(rows, "doc_id bigint, text string"), "k").collect()}
    assert all(r.n_found == r.n_replaced == 1 for r in out.values())
    got = {v: out[i].text[6:-4] for i, v in enumerate(values)}
    assert all(re.sub(r"\d", "9", got[v]) == re.sub(r"\d", "9", v) and got[v][:2] == v[:2] or v[0] == "(" for v in phones)
    # Codes of either sort stay what they are, so no two numbers meet.
    assert got[phones[0]][4] in "01" and got[phones[1]][4] in "01" and got[phones[2]][3] in "23456789" and got[phones[2]][7] in "01"
    days = {datetime.strptime(got[v], f) for v, f in dates.items()} | {datetime.strptime(out[51].text[3:], "%Y-%m-%d")}
    assert len(days) == 1 and out[50].text == out[51].text + "T10:00:00Z"
    letters = spark.createDataFrame([(i, f"{c}@b.org") for i, c in enumerate("abcdefghijklmnopqrstuvwxyz")], "doc_id bigint, text string")
    assert {r.text[0] for r in pseudonyms.pseudonymised(letters, "k").collect()} == set("abcdefghijklmnopqrstuvwxyz")


def test_feistel_is_a_permutation(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("v"))
    symbols = F.transform(F.split("v", ""), lambda c: c.cast("int"))
    out = df.select(pseudonyms.feistel(symbols, F.array(*[F.lit(10)] * 3), "key", F.lit("t")).alias("p"))
    assert out.distinct().count() == 1000
    days = spark.range(146_097).select(F.array((F.col("id") / 773).cast("int"), (F.col("id") % 773).cast("int")).alias("d"))
    moved = days.select(pseudonyms.feistel(F.col("d"), F.array(F.lit(189), F.lit(773)), "key", F.lit("date")).alias("p"))
    assert moved.where("p[0] < 189 AND p[1] < 773").distinct().count() == 146_097


# 3 token files


def test_token_files_round_trip(spark, messy, nothing, tmp_path):
    from tokenizers import Tokenizer

    path = catalog.tokenizer_path()
    folder = str(tmp_path / "t")
    token_files.write_tokens(messy, folder, path, 2)
    rows = token_files.checksums(token_files.read_tokens(spark, folder)).orderBy("start").collect()
    whole = Tokenizer.from_file(path)
    expected = Counter()
    for i, t, _ in MESSY:
        ids = [*whole.encode(t or "", add_special_tokens=False).ids, 2]
        expected[i, len(ids), zlib.crc32(np.asarray(ids, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in rows) == expected
    assert [r.start for r in rows] == list(itertools.accumulate([0, *(r.n_tokens for r in rows)]))[:-1]
    ids = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert ids == sorted(ids)
    file = next((tmp_path / "t").glob("*.parquet"))
    group = pq.ParquetFile(file).metadata.row_group(0)
    kinds = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert "RLE_DICTIONARY" in kinds["ids.list.element"].encodings
    assert "DELTA_BINARY_PACKED" in kinds["start_in_file"].encodings
    assert kinds["doc_id"].has_offset_index and kinds["doc_id"].has_column_index
    token_files.write_tokens(nothing, str(tmp_path / "e"), path, 2)
    assert token_files.read_tokens(spark, str(tmp_path / "e")).count() == 0


def test_encoder_equals_the_library():
    encoder = token_files.WordEncoder(catalog.tokenizer_path())
    odd = [
        "", "  a  b", "Don't <|endoftext|> I'LL go 12½ ²x İstanbul ΣΑΣ été  x　y \tz",
        "it's they're''s ... ,,. a.b,c! \x1c q\x85r \xad1", "日本 text ﬁ ſ's", "A. B, c.\nD", COMMON,
    ]
    for text, ids in zip(odd, encoder.encode(odd), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


# 4 mixing


def test_targets_reshare_the_excess():
    got = mixing.targets({"a": 10, "b": 100, "c": 100}, {"a": 3, "b": 1, "c": 2}, 300, 2)
    assert got["a"] == 20 and got["c"] == pytest.approx(560 / 3) and sum(got.values()) == pytest.approx(300)


def test_flow_prefers_fresh_documents():
    given = mixing.route({("0a",): 100, ("0a", "0b"): 100, ("0b",): 10}, {"0a": 120, "0b": 90}, 2)
    assert sum(given["0a",].values()) == 100 and given["0a", "0b"] == {"0a": 20, "0b": 80} and given["0b",] == {"0b": 10}
    more = mixing.route({("0a",): 50, ("0a", "0b"): 50}, {"0a": 100, "0b": 100}, 2)
    assert more["0a", "0b"]["0b"] == 100 and more["0a",]["0a"] == 100


def test_mix_comes_near_its_targets(spark, documents, messy, nothing):
    rows = mixing.mix(documents, [3, 1, 2], 1.5).join(documents.select("doc_id", "source", "text"), "doc_id").collect()
    again = mixing.mix(documents.repartition(5), [3, 1, 2], 1.5).select("doc_id", "taken").collect()
    assert sorted((r.doc_id, r.taken) for r in rows) == sorted(map(tuple, again))
    by = defaultdict(list)
    for r in rows:
        assert r.size == len(re.findall(r"[^\x20\x09-\x0D]+", r.text)) and r.taken in (0, r.size, 2 * r.size)
        by[r.source].append(r)
    assert sum(v[0].target for v in by.values()) == pytest.approx(1.5 * sum(r.size for r in rows))
    for v in by.values():
        assert v[0].source_size == sum(r.size for r in v)
        assert abs(v[0].target - sum(r.taken for r in v)) <= 0.15 * v[0].target  # ten documents to a source
    odd = mixing.mix(messy, [3, 1, 2], 1.5).collect()
    assert len(odd) == len(MESSY) and all(r.taken <= 2 * r.size for r in odd)
    assert mixing.mix(nothing, [3, 1, 2], 1.5).count() == 0
    assert mixing.mixed_documents(messy, [3, 1, 2], 1.5).columns == messy.columns


# 5 URL filter


@pytest.mark.parametrize("seed", [4, 17])
def test_mix_goes_on_behind_a_huge_document(spark, seed):
    # A document larger than the quota, and many small ones that fill it wherever the large one stands.
    rows = [(0, "w " * 50_000, "a")] + [(i, "w " * (5 + i % 17), "a") for i in range(1, 3_001)]
    rows += [(5_000 + i, "w " * 9, "b") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(4)
    for amount in (0.3, 0.4):
        got = mixing.mix(docs, [1, 0], amount, passes=1, seed=seed).collect()
        taken = sum(r.taken for r in got)
        want = {r.target for r in got if r.doc_id < 5_000}.pop()
        assert abs(taken - int(want)) <= 2 and all(r.copies <= 1 for r in got)
        assert all(r.routed == ["a"] * r.copies for r in got)


def test_fillers_leave_nothing_that_fits(spark):
    rng = np.random.default_rng(2)
    rows = [(p, int(b), float(b) / 10, i, int(s), i) for i, (p, b, s) in enumerate(zip("xyz" * 300, rng.integers(0, 10, 900), rng.integers(1, 400, 900), strict=True))]
    open_ = spark.createDataFrame(rows, "pattern string, bucket bigint, share double, place bigint, size bigint, row bigint")
    left = {"x": 9_000, "y": 37, "z": 0}
    got = mixing.fillers(open_, left).collect()
    assert len({r.row for r in got}) == len(got)
    for p, want in left.items():
        sizes = [rows[r.row][4] for r in got if rows[r.row][0] == p]
        others = [r[4] for r in rows if r[0] == p and r[5] not in {g.row for g in got}]
        short = want - sum(sizes)
        # Nearer than with any document more or, if it goes beyond, without the last one.
        assert all(abs(short - s) >= abs(short) for s in others) and (short >= 0 or any(short + s > -short for s in sizes))


def test_url_filter_judges_by_the_entry_in_force(spark):
    at = lambda s: datetime.fromisoformat(s)
    entries = [
        ("example.com", at("2024-01-10"), "block"), ("Example.com.", at("2024-03-01"), "remove"),
        ("good.example.com", at("2024-02-01"), "allow"), ("x.org", at("2024-01-01"), "allow"), ("x.org", at("2024-01-01"), "block"),
        (None, at("2024-01-01"), "block"), ("y.org", None, "block"), ("z.org", at("2024-01-01"), None),
    ]
    captures = [
        (1, "https://a.example.com/x?y", at("2024-01-09"), "none"), (2, "https://a.example.com/x?y", at("2024-01-10"), "block"),
        (3, "http://u:p@GOOD.example.com.:80/", at("2024-02-01"), "allow"), (4, "http://good.example.com", at("2024-01-20"), "block"),
        (5, "http://good.example.com", at("2025-01-20"), "allow"), (6, "http://example.com", at("2024-03-01"), "none"),
        (7, "http://notexample.com", at("2024-02-01"), "none"), (8, None, at("2024-02-01"), "none"), (9, "no url", at("2024-02-01"), "none"),
        (10, "http://x.org", None, "none"), (11, "http://x.org", at("2024-05-05"), "block"), (11, "http://x.org", at("2024-05-05"), "block"),
    ]
    listed = spark.createDataFrame(entries, "domain string, listed_at timestamp, action string")
    df = spark.createDataFrame(captures, "page_id bigint, url string, fetched timestamp, month string")
    got = url_filter.judged(df, listed)
    assert sorted((r.page_id, r.verdict) for r in got.collect()) == sorted((c[0], c[3]) for c in captures)
    assert {r.verdict for r in url_filter.judged(df, listed.where("false")).collect()} == {"none"}
    assert url_filter.judged(df.where("false"), listed).count() == 0


# 6 line de-duplication


def test_alignment():
    assert line_dedup.aligned([1, 2, 3], [1, 2, 3]) == [(0, 0), (1, 1), (2, 2)]
    assert line_dedup.aligned([9, 1, 5, 2, 8], [1, 7, 2]) == [(1, 0), (3, 2)]
    assert line_dedup.common_positions([2, 3, 1, 1], [3, 1]) == [1, 2, 3]
    assert line_dedup.common_positions([4, 6], [4, 6]) == []  # short lines alone


def test_line_dedup_leaves_no_repeated_line(documents, messy, nothing):
    for df in (documents, messy):
        rows = line_dedup.without_common_blocks(df).collect()
        before = df.collect()
        assert len(rows) == len(before)
        owner = {}
        for r in sorted((r for r in before if r.doc_id is not None), key=lambda r: r.doc_id):
            for line in (r.text or "").split("\n"):
                owner.setdefault(" ".join(WORD.findall(line.lower())), r.doc_id)
        source = texts_of(df)
        for r in rows:
            if r.doc_id is None:
                continue
            kept = r.text.split("\n")
            for line in kept:
                key = " ".join(WORD.findall(line.lower()))
                if len(key.split()) >= line_dedup.LEAST_WORDS:
                    assert owner[key] == r.doc_id
            gone = Counter(source[r.doc_id].split("\n")) - Counter(kept)
            assert r.n_deleted == r.n_lines - (len(kept) if r.n_deleted < r.n_lines else 0)
            for line in gone:
                words_ = WORD.findall(line.lower())
                assert len(words_) < line_dedup.LEAST_WORDS or owner[" ".join(words_)] <= r.doc_id
    odd = Counter((r.doc_id, r.text) for r in line_dedup.without_common_blocks(messy).collect())
    assert odd[2, "Something before this.\nAnd after it more words than that."] == 1 and odd[3, ""] == 2
    assert line_dedup.without_common_blocks(nothing).count() == 0


def test_line_dedup_of_short_lines_between_others_lines(spark):
    one, two = "the first line that has enough words", "the second line that has enough words"
    block = f"{one}\nshort\n\nshorter\nand so\n{two}"
    rows = [(1, f"{one}\nA"), (2, f"B\n{two}"), (3, f"start B\n{block}\nend B"), (4, f"start C\n{block}\nend C"), (5, "short\nshorter\nand so")]
    got = {r.doc_id: r for r in line_dedup.without_common_blocks(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got[3].text == "start B\nshort\n\nshorter\nand so\nend B" and got[3].partners == [1, 2]
    assert got[4].text == "start C\nend C" and 3 in got[4].partners
    assert [got[i].n_deleted for i in (1, 2, 5)] == [0, 0, 0]


# 7 I-Match


def test_fingerprints(documents, messy, nothing):
    texts = texts_of(documents)
    order = sorted(texts, reverse=True)
    rows = imatch.fingerprints(documents).collect()
    seen = defaultdict(set)
    for r in rows:
        text, after = texts[r.doc_id], texts[order[(order.index(r.doc_id) + 1) % len(order)]]
        k = len(text) // 3
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256((text[: len(text) - k] + after[:k]).encode()).hexdigest()
        seen[text].add(r.fingerprint)
    assert len(rows) == len(texts) and all(len(x) == 1 for x in seen.values())
    assert sum(r.near_edited for r in rows) > 5 * sum(r.near_next for r in rows)
    odd = imatch.fingerprints(messy).collect()
    assert len(odd) == len(MESSY)
    assert len({r.fingerprint for r in odd if r.doc_id in (1, 3) and r.n_chars}) == 1
    assert {r.fingerprint for r in odd if r.n_chars == 0} == {"empty"}
    assert imatch.fingerprints(nothing).count() == 0


def scrambled(value):
    value = ((value ^ (value >> 30)) * 0xBF58476D1CE4E5B9) % 2**64
    value = ((value ^ (value >> 27)) * 0x94D049BB133111EB) % 2**64
    return value ^ (value >> 31)


def plain_positions(text, lexicon):
    """{(level, subset): hash of the text's terms in the subset, or None} from the definition, term by term."""
    found = set(WORD.findall(text.lower()))
    ids = {xxhash.xxh64_intdigest(w) for w in (found & lexicon or found)}
    if not ids:
        return None
    first, out = len(ids).bit_length() - 1, {}
    for level in range(first, first + imatch.LEVELS):
        for subset in range(imatch.SUBSETS):
            seed = scrambled((subset + 1) * 0x9E3779B97F4A7C15 % 2**64)
            draws = [scrambled(i ^ seed) for i in ids]
            kept = [scrambled((d + 1) % 2**64) for d in draws if d < 2 ** (64 - level) - 1]
            out[level, subset] = (sum(kept) % 2**64) >> 32 if kept else None
    return out


def plain_likeness(a, b):
    if a == b:
        return 1.0
    common = [(a[k], b[k]) for k in a if k in b and (a[k], b[k]) != (None, None)] if a and b else []
    return sum(x == y for x, y in common) / len(common) if common else 0.0


def test_fingerprints_and_likeness_from_the_definition(documents):
    texts = texts_of(documents)
    order = sorted(texts, reverse=True)
    lexicon = {r.term for r in imatch.lexicon(documents).collect()}
    for r in imatch.fingerprints(documents).collect():
        text, after = texts[r.doc_id], texts[order[(order.index(r.doc_id) + 1) % len(order)]]
        edited = text[: len(text) - len(text) // 3] + after[: len(text) // 3]
        mine, changed, following = (plain_positions(t, lexicon) for t in (text, edited, after))
        for mark, want in ((r.fingerprint, mine), (r.edited_fingerprint, changed)):
            level = min(k[0] for k in want)
            digits = "".join("--------" if want[k] is None else f"{want[k]:08x}" for k in sorted(want))
            assert mark == f"{level}:{digits}"
        assert r.near_edited == pytest.approx(plain_likeness(mine, changed)) and r.near_next == pytest.approx(plain_likeness(mine, following))


def test_lexicon_band(spark):
    docs = spark.createDataFrame([(i, f"all some{i % 2} rare{i} pair{i // 2}") for i in range(8)], "doc_id bigint, text string")
    got = {r.term: r.df for r in imatch.lexicon(docs, 0.2, 0.6).collect()}
    assert got == {"some0": 4, "some1": 4, "pair0": 2, "pair1": 2, "pair2": 2, "pair3": 2}


# 8 decontamination


def test_decontamination_against_brute_force(spark, documents, messy, nothing):
    items = [(1, COMMON), (2, COMMON), (3, "too short"), (4, None), (None, "words of an item without an id that are in no document at all")]
    items = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontaminate.contaminated(messy, items).collect()
    assert Counter((r.doc_id, r.item_id) for r in got) == Counter({(1, 1): 1, (1, 2): 1, (2, 1): 1, (2, 2): 1, (3, 1): 2, (3, 2): 2})
    changed = COMMON.replace("four", "x").replace("nine", "y").split()
    near = spark.createDataFrame([(1, "a b " + " ".join(changed) + " c d"), (2, " ".join(reversed(changed)))], "doc_id bigint, text string")
    assert [(r.doc_id, r.n_agreeing, r.n_words, r.doc_from) for r in decontaminate.contaminated(near, items.where("item_id = 1")).collect()] == [(1, 13, 16, 2)]  # fourteen changes too
    assert decontaminate.clean_documents(messy, items).columns == messy.columns
    assert decontaminate.clean_documents(messy, items).count() == len(MESSY) - 4
    assert decontaminate.contaminated(nothing, items).count() == 0 and decontaminate.contaminated(messy, items.where("false")).count() == 0
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    grams = defaultdict(set)
    for r in bench.collect():
        w = WORD.findall(r.text.lower())
        for k in range(len(w) - 12):
            grams[tuple(w[k : k + 13])].add(r.item_id)
    want = set()
    for d, t in texts_of(documents).items():
        w = WORD.findall(t.lower())
        want |= {(d, i) for k in range(len(w) - 12) for i in grams.get(tuple(w[k : k + 13]), ())}
    got = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(documents, bench).collect()}
    assert want and want <= got and {d for d, _ in got} == {d for d, _ in want}


def _exchanged(n, k):
    """Texts of n words with k inner ones exchanged, in every way."""
    for chosen in itertools.combinations(range(1, n - 1), k):
        yield [f"x{i}" if i in chosen else f"w{i}" for i in range(n)]


def test_masks_miss_no_overlap():
    ids = defaultdict(lambda: len(ids) + 1)
    hashed = lambda w: np.array([ids[x] for x in w], np.uint64)
    for n in [*range(decontaminate.LEAST_ITEM, 21)]:
        whole = hashed(f"w{i}" for i in range(n))
        kinds = [(m, k) for k, m in enumerate(decontaminate.MASKS)]
        kinds = decontaminate.whole_masks(n, 0.8) if n < decontaminate.LEAST_WORDS else kinds
        want = [decontaminate.spaced_hashes(whole, *k) for k in kinds]
        for text in _exchanged(n, n // 5):
            assert any((decontaminate.spaced_hashes(hashed(text), *k) == h).any() for k, h in zip(kinds, want, strict=True)), text
    # Any length: the fewest exchanged words of a text that no mask hits, by the last words (1: exchanged).
    size = 1 << max(map(len, decontaminate.MASKS))
    state = np.arange(size)
    hit = np.any([(state & int(m, 2)) == 0 for m in decontaminate.MASKS], axis=0)
    least = np.full(size, 1e9)
    least[size - 2] = 0
    for n in range(2, 400):
        after = np.full(size, 1e9)
        for differs in (0, 1):
            np.minimum.at(after, (state << 1 | differs) & size - 1, least + differs)
        least = np.where(hit, 1e9, after)
        assert n < decontaminate.LEAST_WORDS or least[::2].min() > n // 5


def test_decontamination_finds_every_exchange(spark):
    sizes = {1: (13, 2), 2: (15, 3), 3: (9, 1), 4: (11, 2), 5: (5, 1)}
    rows = [(1000 * i + j, "before it " + " ".join(w).replace("w", f"w{i}v") + " after it") for i, x in sizes.items() for j, w in enumerate(_exchanged(*x))]
    items = [(i, " ".join(f"w{i}v{j}" for j in range(n))) for i, (n, _) in sizes.items()]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    got = decontaminate.contaminated(docs, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == sorted((d, d // 1000) for d, _ in rows)
    assert all((r.doc_from, r.n_words, r.n_words - r.n_agreeing) == (2, *sizes[r.item_id]) for r in got)


def test_best_overlap_against_all_stretches():
    rng = np.random.default_rng(5)
    # A longer stretch that is alike enough only with differing words at its ends, and one that counts elsewhere.
    cases = ["011111110111100011110111100101001010111111111", "001111111110110001110000101101001111110111101"]
    cases += ["".join(rng.choice(["0", "1"], n, p=[q, 1 - q])) for n in (5, 9, 13, 20, 40, 70) for q in (0.1, 0.2, 0.3, 0.5) for _ in range(60)]
    for same in cases:
        item = np.arange(len(same), dtype=np.int64)
        document = np.where(np.array(list(same)) == "1", item, -1)
        least = min(13, len(same))
        fits = [
            (j - i, same[i:j].count("1"))
            for i in range(len(same)) for j in range(i + least, len(same) + 1)
            if same[i] == same[j - 1] == "1" and 5 * same[i:j].count("1") >= 4 * (j - i)
        ]
        got = decontaminate.best_overlap(document, item, 0, 13, 0.8)
        assert (got is None) == (not fits)
        if got:
            assert (got[1] - got[0], got[2]) in fits and got[1] - got[0] == max(fits)[0] and same[got[0] : got[1]].count("1") == got[2]


# 9 n-gram Jaccard join


def _brute_links(texts: dict, n=5, least=0.8):
    classes = defaultdict(list)
    for d in sorted(texts):
        classes[tuple(WORD.findall(texts[d].lower()))].append(d)
    sets = {v[0]: {k[i : i + n] for i in range(max(1, len(k) - n + 1))} if k else set() for k, v in classes.items()}
    links = {(a, b) for a, b in itertools.combinations(sorted(sets), 2) if sets[a] and sets[b] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= least}
    return {d: v[0] for v in classes.values() for d in v}, links


def test_jaccard_join_against_brute_force(spark, monkeypatch):
    # No block in this table is full, so the blocks are made small: a group is split over several tasks.
    monkeypatch.setattr(jaccard_join, "BLOCK", 7)
    base = [f"t{i}" for i in range(120)]
    rows, rng = [], np.random.default_rng(3)
    for i in range(40):
        w = list(base)
        for k in rng.choice(120, i % 5, replace=False):
            w[k] = f"e{i}x{k}"
        rows.append((i, " ".join(w)))
    rows += [(100 + i, f"other {i} words " + " ".join(f"u{i}v{j}" for j in range(30))) for i in range(30)]
    rows += [(200, rows[3][1].upper() + "!"), (201, ""), (202, "one two"), (203, "One, two.")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    classes, links = _brute_links(dict(rows))
    join = jaccard_join.JaccardJoin(docs)
    assert {tuple(sorted((r.class_a, r.class_b))) for r in join.pairs().collect()} == links
    count = Counter(x for pair in links for x in pair)
    got = jaccard_join.jaccard_links(docs).collect()
    assert {r.doc_id: (r.class_id, r.n_links) for r in got} == {d: (c, count[c]) for d, c in classes.items()}
    group = {d: d for d in classes.values()}
    for _ in range(60):
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    assert {r.doc_id: r.group_id for r in got} == {d: group[c] for d, c in classes.items()}
    kept = {r.doc_id for r in jaccard_join.one_of_each(docs).collect()}
    assert kept == {min(d for d, c in classes.items() if group[c] == g) for g in set(group.values())}


def test_jaccard_join_of_odd_tables(messy, nothing):
    got = jaccard_join.jaccard_links(messy).collect()
    assert len(got) == len(MESSY)
    assert {r.class_id for r in got if r.doc_id == 3} == {1} and {r.class_id for r in got if r.doc_id in (4, 5, 9)} == {4}
    assert jaccard_join.jaccard_links(nothing).count() == 0
    kept = jaccard_join.one_of_each(messy)
    assert kept.columns == messy.columns and sorted(r.doc_id for r in kept.where("doc_id IS NOT NULL").collect()) == [1, 2, 4, 6, 7, 8]


def test_band_choice_reaches_its_recall():
    bands, rows = jaccard_join.choose_bands(0.8, 0.9999, 96)
    assert bands * rows <= 96 and 1 - (1 - 0.8**rows) ** bands >= 0.9999


# 10 style tree


def test_main_text(spark):
    page = (
        '<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header class="x">Top</header><nav><ul><li>Menu</ul></nav>'
        '<div class="cookie-notice">Cookies</div><article class="post"><header><h1>A &amp; B&nbsp;&copy;</h1></header><p>one <b>two<br>three'
        '<p>x &lt; y  \n z<script>var t="</p>";</script></p><div class="ad">Buy</div><form><p>Mail</p></form><aside>Side</aside>'
        '<ul><li>first<li>second</ul><section id="comments"><p>Reader</p></section><p hidden>no</p></article><footer>&copy; F</footer>'
    )
    plain = [f'<body><div id="m">Home | About</div><div class="c">Story {i} is about {i * i} things</div><div>Same words</div></body>' for i in range(6)]
    rows = [(1, "https://a.example/x", page), (2, None, None), (3, "x", ""), (4, "https://a.example/y", "plain &eacute; text")]
    rows += [(10 + i, f"https://b.example/{i}", p) for i, p in enumerate(plain)] + [(1, "https://a.example/x", page)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").withColumn("host", F.lit("h"))
    got = defaultdict(list)
    for r in style_tree.main_text(df).collect():
        assert r.n_chars == len(r.text)
        got[r.page_id].append(r.text)
    assert got[1] == ["A & B ©\none two three\nx < y z\nfirst\nsecond"] * 2
    assert got[2] == [""] and got[3] == [""] and got[4] == ["plain é text"]
    assert [got[10 + i] for i in range(6)] == [[f"Story {i} is about {i * i} things"] for i in range(6)]
    assert style_tree.main_text(df.where("false")).count() == 0


def test_main_text_of_the_given_pages(spark):
    rows = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r.text for r in style_tree.main_text(rows).collect()}
    for r in rows.collect():
        inner = r.html[r.html.index("<article>") : r.html.index("</article>")]
        parts = re.split(r"</?(?:p|h1|article)\b[^>]*>", inner)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br>" in p else "", p)).split()) for p in parts]
        assert got[r.page_id] == "\n".join(p for p in parts if p)


def test_articles_are_part_of_the_tree(spark):
    story = lambda i: f"Story {i} tells of {i * i} things that happened"
    rows = [(i, f"https://c.example/{i}", f"<body><article><h1>Title {i}</h1><p>{story(i)}<p>Join our readers every day<div>All rights kept</div></article></body>") for i in range(8)]
    # teasers next to the story, and a comment marked up as an article
    rows += [(20 + i, f"https://d.example/{i}", f'<body><div class="story">{story(i)} and on and on</div><article>Teaser {i}</article><article class="comment even">Me too {i}</article></body>') for i in range(8)]
    rows += [(40, "https://e.example/1", f'<body><div>{story(40)} and on</div><article class="post comments-open">Teaser</article></body>')]
    # too few words outside a lone article, and copies of one page, which tell nothing of each other
    rows += [(41, "https://f.example/1", f"<body><div>Day 1</div><article>{story(41) * 5}</article></body>")]
    rows += [(50 + i, f"https://g.example/{i}", f"<body><nav>{i}</nav><article><p>{story(50)}</article></body>") for i in range(9)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in style_tree.main_text(df).collect()}
    assert [got[i] for i in range(8)] == [f"Title {i}\n{story(i)}" for i in range(8)]
    assert [got[20 + i] for i in range(8)] == [f"{story(i)} and on and on\nTeaser {i}" for i in range(8)]
    assert got[40] == f"{story(40)} and on\nTeaser" and got[41] == story(41) * 5
    assert [got[50 + i] for i in range(9)] == [story(50)] * 9


def test_rare_templates_and_numbered_wrappers(spark):
    rows = []
    for i in range(80):
        notice = "<section><p>Same note on few pages</section>" if i < 4 else ""
        rows.append((i, "https://h.example/", f"<body><div class='t{'abcdefgh'[i % 8]}'>Story {i} of {i * i}</div>{notice}</body>"))
    rows += [(100 + i, "https://i.example/", f'<body><div id="post-{i}" class="post post-{i}"><p>Story {i} of {i * i}</p><div>Same note</div></div></body>') for i in range(6)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in style_tree.main_text(df).collect()}
    assert got == {i: f"Story {i % 100} of {(i % 100) ** 2}" for i in got} and len(got) == 86


# The pipeline


def test_pipeline_against_brute_force(spark):
    out = corpus_pipeline.run(spark, SF).collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    models = toxicity.train(docs, labels)
    toxic = {r.doc_id for r in toxicity.scores(docs, models).where("toxic").collect()}
    texts = {d: t for d, t in texts_of(docs).items() if d not in toxic}
    classes, links = _brute_links(texts)
    group = {d: d for d in classes.values()}
    for _ in range(20):
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    least = {}
    for d, c in classes.items():
        least[group[c]] = min(d, least.get(group[c], d))
    kept = set(least.values())
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    leaks = {r.doc_id for r in decontaminate.contaminated(docs, bench).collect()}
    kept -= leaks
    left = docs.where(F.col("doc_id").isin(list(kept)))
    copies = {r.doc_id: r.copies for r in mixing.mix(left, catalog.WEIGHTS, catalog.AMOUNT).collect()}
    assert Counter(r.doc_id for r in out) == Counter({d: c for d, c in copies.items() if c})
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(catalog.tokenizer_path())
    for r in out:
        assert r.n_tokens == len(whole.encode(texts[r.doc_id], add_special_tokens=False).ids) + 1
