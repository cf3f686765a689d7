import random

import pyarrow as pa
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from pairloom.config import CleanOptions
from pairloom.functions import align
from pairloom.operators import chunks, fidelity, repeats, terms
from pairloom.operators.cleaning import RuleCleaner, WorkerCleaner, clean_batch, clean_texts, dynamic_batches, run_cases
from pairloom.operators.tokenizers import ByteLibrary, WorkerTokenizer

@pytest.mark.parametrize("rule, raw, cleaned", [
    ("byte order mark", "\ufeffone\n\ufefftwo", "one\ntwo"),
    ("no-break space", "a\u00c2\u00a0b\u00a0c", "a b\u00a0c"),
    ("null in hex", "10x00 apples", "1 apples"),
    ("nothing", "0x0 and \u00c2 stay", "0x0 and \u00c2 stay"),
])
def test_character_rules(spark, rule, raw, cleaned):
    df = spark.createDataFrame([("en", raw)], "lang string, raw string")
    assert clean_texts(df, RuleCleaner()).first()["cleaned"] == cleaned


ENTRIES = {"en": ("Home", "Skip to content", "(c) 2001"), "id": ("Beranda", "Kembali ke atas", "Hak cipta 2001"),
           "zh": ("首页", "返回顶部", "版权所有 2001")}
SENTENCE = {"en": "The river rose by 3 metres.", "id": "Sungai naik 3 meter.", "zh": "河水上涨三米。"}


@pytest.mark.parametrize("lang", ENTRIES)
def test_only_lines_of_nothing_but_furniture_go(spark, lang):
    """Furniture alone and in rows goes; content stays, also on one line with furniture and in one-line texts."""
    sentence, rows = SENTENCE[lang], []
    for entry in ENTRIES[lang]:
        rows += [
            (f"{entry}\n{sentence}\n {entry.upper()} ", sentence),
            (f"{sentence}\n{' | '.join(ENTRIES[lang])}", sentence),
            (f"{entry} {sentence}", f"{entry} {sentence}"),
            (f"{sentence} {entry}", f"{sentence} {entry}"),
            (f"{entry} | {sentence}", f"{entry} | {sentence}"),
        ]
    rows.append((f"{sentence} All rights reserved to nobody. Hak cipta dilindungi siapa? {sentence}",) * 2)
    df = spark.createDataFrame([(lang, *r) for r in rows], "lang string, raw string, want string")
    for r in clean_texts(df, RuleCleaner()).collect():
        assert (r["status"], r["cleaned"]) == ("ok", r["want"])


@pytest.mark.parametrize("unit", ["1,", "1.", "1", "home | ", "- a\n", "|a", "0x00", "1. ", "a ", "\n"])
def test_patterns_hold_on_a_megabyte_of_one_unit(spark, unit):
    text = unit * (1_000_000 // len(unit))
    df = spark.createDataFrame([(0, "en", text, text)], "id int, lang string, raw string, clean string")
    clean_texts(df, RuleCleaner(), max_input=1 << 30).select(F.length("cleaned")).collect()
    assert df.select(fidelity.number_loss()).first()[0] == 0
    fidelity.structure_loss(df).collect()
    assert fidelity.fidelity_summary(df).count() == 2


def test_cases_are_previewed(spark):
    long = spark.createDataFrame([("n", "en", "é" * 300, "x"), ("m", "en", "", "y")], "name string, lang string, raw string, expect string")
    rows = run_cases(long, RuleCleaner()).collect()
    assert rows[0]["raw_preview"] == "é" * 110 + "..." and rows[0]["clean_preview"] == "é" * 220 + "..."
    assert rows[1]["clean_preview"] == "" and rows[1]["status"] == "empty"


class Upper:
    loads = 0

    def __init__(self, options):
        Upper.loads += 1
        self.options = options

    def __call__(self, texts):
        assert all(t.startswith("<") and len(t) > 5 for t in texts)
        return [f" {t.upper()}:{self.options.num_beams}:{Upper.loads}\n" for t in texts]


def test_worker_cleaner_sees_only_texts_to_clean(spark):
    rows = [
        (0, "en", "abc"), (1, "en", ""), (2, "en", "  "), (3, "fr", "x"), (4, None, "x"), (5, "en", None),
        (6, "en", "y" * 20), (7, "en", "y" * 9),
    ]
    df = spark.createDataFrame(rows, "id int, lang string, raw string")
    cleaner = WorkerCleaner(Upper, CleanOptions(num_beams=3))
    got = {r["id"]: r for r in clean_texts(df, cleaner, max_input=15).collect()}
    status = {i: r["status"] for i, r in got.items()}
    assert status == {
        0: "ok", 1: "empty", 2: "ok", 3: "bad_lang", 4: "bad_lang", 5: "bad_text", 6: "over_budget", 7: "ok",
    }
    # one load per worker process, however many batches
    assert got[0]["cleaned"] == "<EN> ABC:3:1" and got[2]["cleaned"] == "<EN>   :3:1"
    assert got[1]["cleaned"] == "" and got[7]["n_tokens"] == 15 and got[6]["n_tokens"] == 26
    assert all(got[i]["cleaned"] is None for i in (3, 4, 5, 6))


def test_refusals_can_fail_the_job(spark):
    df = spark.createDataFrame([("en", "abc"), ("fr", "x")], "lang string, raw string")
    with pytest.raises(PySparkException, match="text refused: bad_lang"):
        clean_texts(df, RuleCleaner(), on_reject="fail").collect()
    assert clean_texts(df.filter("lang = 'en'"), RuleCleaner(), on_reject="fail").first()["cleaned"] == "abc"
    with pytest.raises(ValueError):
        clean_texts(df, RuleCleaner(), on_reject="ignore")


def test_text_of_another_type_is_refused(spark):
    df = spark.createDataFrame([("en", 5)], "lang string, raw int")
    assert clean_texts(df.withColumn("raw", F.col("raw").cast("int")), RuleCleaner()).first()["status"] == "bad_text"


def test_chunks_join_to_the_pair_and_fit(spark, pairs_of):
    raw = "\n".join("r" * (i * 7 % 40) for i in range(200))
    clean = "\n".join("c" * (i * 5 % 23) for i in range(200))
    df = pairs_of(
        ("en", raw, clean), ("en", "a\nb", "a"), ("zh", "", ""), ("en", "x" * 99 + "\ny\nz", "1\n2\n3"),
        ("en", "\n\n", "\n\n"), ("en", "a b\n" * 20 + "c", "d"), (None, "a" * 99, "b" * 99), ("en", None, "b" * 99),
    )
    rows = chunks.chunk_pairs(df, "id", 60, 50).collect()
    by_id = {}
    for r in sorted(rows, key=lambda r: (r["id"], r["chunk_no"])):
        by_id.setdefault(r["id"], []).append(r)
    source = {r["id"]: r for r in df.collect()}
    for i, parts in by_id.items():
        if i > 5:  # a null stays as it is
            assert [(p["chunk_no"], p["status"], p["raw"], p["clean"]) for p in parts] == [(0, "null", *source[i][2:])]
            continue
        assert [p["chunk_no"] for p in parts] == list(range(len(parts)))
        assert "\n".join(p["raw"] for p in parts) == source[i]["raw"]
        assert "\n".join(p["clean"] for p in parts) == source[i]["clean"]
        for p in parts:
            if p["status"] == "ok":
                assert len(f"<{p['lang']}> {p['raw']}".encode()) + 1 <= 60 and len(p["clean"].encode()) + 1 <= 50
    assert len(by_id[0]) > 20 and {p["status"] for p in by_id[0]} == {"ok"}
    # no two neighbours would have fitted together
    for a, b in zip(by_id[0], by_id[0][1:]):
        first_raw, first_clean = b["raw"].split("\n")[0], b["clean"].split("\n")[0]
        assert len(f"<en> {a['raw']}\n{first_raw}") + 1 > 60 or len(f"{a['clean']}\n{first_clean}") + 1 > 50
    assert [p["status"] for p in by_id[1]] == ["ok"]  # it fits
    assert [p["status"] for p in by_id[2]] == ["ok"]
    assert [p["status"] for p in by_id[3]] == ["over_budget", "ok"]
    assert len(by_id[4]) == 1
    assert [p["status"] for p in by_id[5]] == ["unaligned"]


def lossy(seed, n=300):
    """Lines, and the lines that are left when a tenth is dropped and some are changed; with the true pairs."""
    rng = random.Random(seed)
    lines = [" ".join(rng.choice("abcdefghij") * rng.randrange(1, 4) for _ in range(rng.randrange(1, 9))) for _ in range(n)]
    kept = [i for i in range(n) if rng.random() >= 0.1]
    return lines, [lines[i] + (" #" if rng.random() < 0.1 else "") for i in kept], kept


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_pairs_that_lost_lines_are_cut_at_matching_places(spark, pairs_of, seed):
    raw, clean, kept = lossy(seed)
    rows = chunks.chunk_pairs(pairs_of(("en", "\n".join(raw), "\n".join(clean))), "id", 400, 400).orderBy("chunk_no").collect()
    assert len(rows) > 10 and {r["status"] for r in rows} == {"ok"}
    assert "\n".join(r["raw"] for r in rows) == "\n".join(raw)
    assert "\n".join(r["clean"] for r in rows) == "\n".join(clean)
    i = j = 0
    for r in rows[:-1]:
        i, j = i + r["raw"].count("\n") + 1, j + r["clean"].count("\n") + 1
        assert kept[j] == i  # the next chunk begins with two versions of one line


class HalfLibrary:
    """A token for every two characters: fewer for a chunk than for its lines together."""

    def encode_batch(self, texts):
        return [[5] * -(-len(t) // 2) for t in texts]


class GreedyLibrary:
    """Lines cost more together than alone, so chunks turn out too long at first."""

    def encode_batch(self, texts):
        return [[5] * (len(t) + 3 * t.strip().count("\n")) for t in texts]


@pytest.mark.parametrize("library", [HalfLibrary, GreedyLibrary])
def test_chunks_fit_by_the_tokens_of_a_plug_in(spark, pairs_of, library):
    raw, clean, _ = lossy(9, 80)
    df = pairs_of(("en", "\n".join(raw), "\n".join(clean)), ("en", "short", "short"))
    rows = chunks.chunk_pairs(df, "id", 90, 80, WorkerTokenizer(library, "plug-in", eos_id=1)).orderBy("id", "chunk_no").collect()
    parts = [r for r in rows if r["id"] == 0]
    assert "\n".join(r["raw"] for r in parts) == "\n".join(raw) and len(parts) > 5
    for r in parts:
        n, m = (len(ids) + 1 for ids in library().encode_batch([f"<en> {r['raw']}", r["clean"]]))
        assert (r["status"] == "ok") == (n <= 90 and m <= 80)
    assert sum(r["status"] == "ok" for r in parts) > 5 and rows[-1]["status"] == "ok"


def best_by_trial(a, b):
    """The largest sum of likenesses over all rising matchings."""
    if not a or not b:
        return 0.0
    like = 1.0 if a[0] == b[0] else align.likeness(align.words_of(a[0]), align.words_of(b[0]))
    together = like + best_by_trial(a[1:], b[1:]) if like else 0.0
    return max(together, best_by_trial(a[1:], b), best_by_trial(a, b[1:]))


def test_matching_equals_trying_all():
    rng = random.Random(8)
    for _ in range(150):
        a, b = ([" ".join(rng.choices("xyz", k=rng.randrange(3))) for _ in range(rng.randrange(7))] for _ in range(2))
        pairs = list(align.best_matching(a, b))
        assert all(i < k and j < m for (i, j), (k, m) in zip(pairs, pairs[1:]))
        total = sum(1.0 if a[i] == b[j] else align.likeness(align.words_of(a[i]), align.words_of(b[j])) for i, j in pairs)
        assert total == pytest.approx(best_by_trial(a, b))
        every = align.matched_lines(a, b)
        assert all(i < k and j < m for (i, j), (k, m) in zip(every, every[1:]))
        if len(a) == len(b) and not set(a) & set(b):
            assert every == [(i, i) for i in range(len(a))]


def test_gaps_beyond_the_bound_stay_whole(monkeypatch):
    monkeypatch.setattr(align, "CELLS", 1)
    assert align.matched_lines(["p", "x", "x y", "q"], ["p", "y", "q"]) == [(0, 0), (3, 2)]


def changed(seed, n):
    """Lines, and those left when a twentieth is dropped and every one is changed; with the numbers of those left."""
    rng = random.Random(seed)
    lines = [" ".join(f"w{rng.randrange(99)}" for _ in range(rng.randrange(4, 9))) for _ in range(n)]
    kept = [i for i in range(n) if rng.random() >= 0.05]
    return lines, [lines[i] + " #" for i in kept], kept


def test_gaps_of_every_size_are_matched(spark, pairs_of):
    for n in (200, 300, 2000):  # 300 lines on one side times 285 on the other were left unmatched once
        raw, clean, kept = changed(n, n)
        assert align.matched_lines(raw, clean) == [(i, j) for j, i in enumerate(kept)]
    raw, clean, kept = changed(300, 300)
    rows = chunks.chunk_pairs(pairs_of(("en", "\n".join(raw), "\n".join(clean))), "id", 400, 400).orderBy("chunk_no").collect()
    assert len(rows) > 10 and {r["status"] for r in rows} == {"ok"}
    i = j = 0
    for r in rows[:-1]:
        i, j = i + r["raw"].count("\n") + 1, j + r["clean"].count("\n") + 1
        assert kept[j] == i


@pytest.mark.parametrize("held", [1, 40, 1 << 22])
def test_matching_by_rows_equals_the_table(monkeypatch, held):
    monkeypatch.setattr(align, "SMALL", 0)
    monkeypatch.setattr(align, "HELD", held)
    rng = random.Random(held)

    def line():
        words = " ".join(rng.choices("xyz", k=rng.randrange(4)))
        return rng.choice([words, words, words + " #", "--"])

    for _ in range(300):
        a, b = ([line() for _ in range(rng.randrange(1, 20))] for _ in range(2))
        assert list(align.best_matching(a, b)) == list(align._by_table(a, b))


def test_losses(spark, pairs_of):
    df = pairs_of(
        ("en", "1. one 5 5 3,400\n- item\n| a | b |\nend 7", "one 5 3400\nitem\nend 7\none 5 3400"),
        ("en", "", ""), ("zh", "x\n \n", "y"),
    )
    got = df.orderBy("id").select(
        fidelity.number_loss().alias("n"), fidelity.duplication_count().alias("d"), fidelity.ending_kept().alias("e")
    ).collect()
    # lost: the 1, one 5, and 3,400; raw's last line that is not blank is its end
    assert [r["n"] for r in got] == [2, 0, 0]
    assert [r["d"] for r in got] == [3, 0, 1]
    assert [r["e"] for r in got] == [True, True, False]
    s = fidelity.structure_loss(df).orderBy("id").first()
    assert (s["items_raw"], s["items_clean"], s["items_lost"]) == (2, 0, 2)
    assert (s["rows_raw"], s["rows_clean"], s["rows_lost"]) == (1, 0, 1)


def test_duplicated_lines(pairs_of):
    df = pairs_of(("en", "a\nb\nb", "b\nb\nb\na\nc"), ("en", "a", "a"))
    rows = {(r["line"], r["n_raw"], r["n_clean"]) for r in fidelity.duplicated_lines(df, "id").collect()}
    assert rows == {("b", 2, 3), ("c", 0, 1)}


@pytest.mark.parametrize("part_bytes", [1 << 20, 40])
def test_term_loss(spark, pairs_of, monkeypatch, part_bytes):
    monkeypatch.setattr(terms, "LEXICON_BYTES", part_bytes)  # the small one makes a part of every term or two
    listed = [("en", "negation", "not"), ("en", "negation", "no"), ("en", "hedge", "may"), ("fr", "hedge", "may"),
              ("en", "hedge", "may"), ("en", "hedge", None), ("en", "hedge", ""), (None, "hedge", "may")]
    lexicon = spark.createDataFrame(listed, "lang string, kind string, term string")
    df = pairs_of(
        ("en", "Not, no no; may! nothing", "no may may"), ("en", "plain", "not"), ("fr", "no may", "no"), ("en", "", ""),
        (None, "may", ""), ("en", None, "may"), ("en", "may", None), ("de", "may", ""),
    )
    losses = terms.term_loss(df, "id", lexicon, unspaced=())
    got = {(r["id"], r["kind"]): (r["n_raw"], r["n_clean"], r["lost"]) for r in losses.collect()}
    assert got == {
        (0, "negation"): (3, 1, 2), (0, "hedge"): (1, 2, 0), (1, "negation"): (0, 1, 0), (2, "hedge"): (1, 0, 1),
        (5, "hedge"): (0, 1, 0), (6, "hedge"): (1, 0, 1),
    }
    total = {(r["lang"], r["kind"], r["is_total"]): r["lost"] for r in fidelity.term_summary(losses).collect()}
    assert total == {
        ("en", "negation", False): 2, ("en", "hedge", False): 1, ("fr", "hedge", False): 1,
        (None, "negation", True): 2, (None, "hedge", True): 2,
    }


def test_no_word_is_shuffled_for_terms(spark, pairs_of):
    lexicon = spark.createDataFrame([("en", "hedge", "may")], "lang string, kind string, term string")
    found = terms.term_loss(pairs_of(("en", "may", "")), "id", lexicon)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" in plan


def test_an_empty_lexicon_finds_nothing(spark, pairs_of):
    lexicon = spark.createDataFrame([], "lang string, kind string, term string")
    assert terms.term_loss(pairs_of(("en", "may", "")), "id", lexicon).collect() == []


@pytest.mark.parametrize("whole", [True, False])
def test_finder_equals_a_search_per_term(whole):
    rng = random.Random(3)
    words = ["a", "ab", "aba", "b a", "né", "9", "不"]
    for _ in range(200):
        text = "".join(rng.choice("ab é不9n,") for _ in range(rng.randrange(40)))
        expect = {}
        for word in words:
            at = n = 0
            while (at := text.find(word, at)) >= 0:
                end = at + len(word)
                touched = whole and (text[at - 1 : at].isalnum() or text[end : end + 1].isalnum())
                n, at = (n, at + 1) if touched else (n + 1, end)
            if n:
                expect[word] = n
        assert terms.Finder(words, whole).count(text) == expect


def test_terms_without_spaces(spark, pairs_of):
    lexicon = spark.createDataFrame([("zh", "negation", "不"), ("zh", "hedge", "可能")], "lang string, kind string, term string")
    df = pairs_of(("zh", "他不不可能来", "他可能来"), ("zh", "无", "无"))
    rows = terms.term_loss(df, "id", lexicon).collect()
    assert {(r["id"], r["kind"]): r["lost"] for r in rows} == {(0, "negation"): 2, (0, "hedge"): 0}


def test_summary(spark, pairs_of):
    df = pairs_of(("en", "5\n6", "5"), ("zh", "7", "7"))
    rows = {(r["lang"], r["is_total"]): r for r in fidelity.fidelity_summary(df).collect()}
    assert set(rows) == {("en", False), ("zh", False), (None, True)}
    assert rows[None, True]["numbers"] == 3 and rows[None, True]["numbers_lost"] == 1
    assert rows["en", False]["endings_kept"] == 0 and rows["zh", False]["endings_kept"] == 1


def test_dynamic_batches_keep_to_their_budget():
    rng = random.Random(2)
    for _ in range(50):
        sizes = [rng.randrange(1, 60) for _ in range(rng.randrange(40))]
        batches = list(dynamic_batches(sizes, 100))
        assert sorted(i for b in batches for i in b) == list(range(len(sizes)))
        for a, b in zip(batches, batches[1:]):  # longest first, and no batch could have taken the next text
            assert min(sizes[i] for i in a) >= max(sizes[i] for i in b)
            assert sizes[a[0]] * (len(a) + 1) > 100
        assert all(len(b) == 1 or sizes[b[0]] * len(b) <= 100 for b in batches)


def test_a_model_is_asked_in_batches_and_rows_keep_their_order():
    asked = []

    def model(texts):
        asked.append([len(t) for t in texts])
        return [t.upper() for t in texts]

    texts = ["aaaa", None, "b", "cc" * 9, "d", "", "eee"]
    got = clean_batch(model, pa.array(texts), ByteLibrary(), 8, buffer=5)
    assert got.to_pylist() == [t if t is None else t.upper() for t in texts]
    assert asked == [[18], [4, 1], [1], [3, 0]]
    with pytest.raises(ValueError, match="1 texts for 2"):
        clean_batch(lambda t: t[:1], pa.array(["a", "b"]), ByteLibrary(), 8)


def spans_by_search(raw, clean, least):
    """Starts of runs that are one too many, found by comparing runs one by one."""
    before, after = raw.split(), clean.split()
    runs = [after[i : i + least] for i in range(len(after) - least + 1)]
    flagged = []
    for i, run in enumerate(runs):
        allowed = max(1, sum(before[j : j + least] == run for j in range(len(before) - least + 1)))
        flagged.append(sum(r == run for r in runs[: i + 1]) > allowed)
    out, i = [], 0
    while i < len(flagged):
        if flagged[i]:
            j = i
            while j < len(flagged) and flagged[j]:
                j += 1
            out.append((i, j - i + least - 1, " ".join(after[i : j + least - 1])))
            i = j
        i += 1
    return out


@pytest.mark.parametrize("least", [1, 2, 3, 5, 8])
def test_repeated_spans_equal_a_search(least):
    rng = random.Random(least)
    for _ in range(150):
        raw, clean = (" ".join(rng.choices("abc", k=rng.randrange(30))) for _ in range(2))
        got = [(s["start"], s["n_words"], s["span"]) for s in repeats.spans_of(raw, clean, least)]
        assert got == spans_by_search(raw, clean, least)


def test_a_sentence_doubled_in_a_one_line_text_is_found(spark, pairs_of):
    one = "The river rose by three metres in a single night."
    df = pairs_of(
        ("en", one, f"{one} {one}"), ("en", f"{one} {one}", f"{one} {one}"), ("zh", "河水一夜之间上涨三米", "河水一夜之间上涨三米河水一夜之间上涨三米"),
        ("en", None, f"{one} {one}"), (None, one, None), ("en", "", ""),
    )
    got = {(r["id"], r["start"], r["n_words"], r["span"]) for r in repeats.repeated_spans(df, "id").collect()}
    assert got == {(0, 10, 10, one), (2, 10, 10, "河水一夜之间上涨三米"), (3, 10, 10, one)}
    with pytest.raises(ValueError, match="least"):
        repeats.repeated_spans(df, "id", 0)
