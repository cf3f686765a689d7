"""Cleaning whole tables of texts with a pluggable cleaner."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from pairloom.config import LANGUAGES, MAX_INPUT, CleanOptions
from pairloom.functions.text import lines, prefixed, preview_text, strip_text
from pairloom.operators.tokenizers import ByteTokenizer, WorkerTokenizer, count_batch
from pairloom.session import ship_package

BYTES = ByteTokenizer()

# Entries of page furniture, per language. A line goes only if it is nothing else: one entry, or several
# parted by bars. What a site adds in words of its own stays.
FURNITURE = {
    "en": (
        "home", "menu", "search", "log ?in", "log ?out", "sign ?in", "sign ?up", "register", "about us", "contact us",
        "skip to (?:main )?content", "back to top", "read more", "next page", "previous page", "print this page",
        "privacy policy", "cookie (?:policy|settings)", "terms of (?:use|service)", "all rights reserved",
        r"(?:\(c\)|©|copyright)(?: \(c\)| ©)? ?[0-9]{4}(?: ?[-–] ?[0-9]{4})?",
    ),
    "id": (
        "beranda", "menu", "cari", "masuk", "keluar", "daftar", "tentang kami", "hubungi kami", "kembali ke atas",
        "selengkapnya", "halaman berikutnya", "halaman sebelumnya", "cetak halaman ini", "kebijakan privasi",
        "syarat dan ketentuan", "hak cipta dilindungi(?: undang-undang)?", r"(?:hak cipta|©|\(c\)) ?[0-9]{4}",
    ),
    "zh": (
        "首页", "菜单", "搜索", "登录", "注册", "退出", "关于我们", "联系我们", "返回顶部", "上一页", "下一页", "打印本页",
        "隐私政策", "使用条款", "版权所有(?: ?[0-9]{4})?",
    ),
}


def whole_line(entries: Sequence[str]) -> str:
    """A pattern for lines of these entries only, at most 20 of them, parted by bars or middle dots."""
    one = f"(?:{'|'.join(entries)})"
    return rf"^{one}(?: ?[|·] ?{one}){{0,19}}\.?$"


BOILERPLATE = {lang: whole_line(entries) for lang, entries in FURNITURE.items()}


@dataclass(frozen=True)
class RuleCleaner:
    """Removes what is certainly an artifact, as column expressions. Doubtful text stays.

    ``boilerplate`` maps a language to a pattern for lines to drop; other languages lose none.
    """

    boilerplate: Mapping[str, str] = field(default_factory=lambda: dict(BOILERPLATE))

    def column(self, text: Column, lang: Column) -> Column:
        return self.drop_boilerplate(drop_hex_artifact(fix_mojibake(drop_bom(text))), lang)

    def drop_boilerplate(self, text: Column, lang: Column) -> Column:
        if not self.boilerplate:
            return text
        cleaned = text
        for code, pattern in self.boilerplate.items():
            cleaned = F.when(lang == code, drop_lines(text, pattern)).otherwise(cleaned)
        return cleaned


def drop_bom(text: Column) -> Column:
    return F.replace(text, F.lit("\ufeff"), F.lit(""))


def fix_mojibake(text: Column) -> Column:
    """A no-break space decoded with the wrong character set becomes a space."""
    return F.replace(text, F.lit("\u00c2\u00a0"), F.lit(" "))


def drop_hex_artifact(text: Column) -> Column:
    """Remove the literal ``0x00``. Digits around it are not guessed at."""
    return F.replace(text, F.lit("0x00"), F.lit(""))


def drop_lines(text: Column, pattern: str) -> Column:
    """The text without the lines whose stripped form matches, in any case."""
    kept = F.filter(lines(text), lambda line: ~strip_text(line).rlike(f"(?i){pattern}"))
    return F.array_join(kept, "\n")


#: Texts that are sorted by length together.
BUFFER = 1024


@dataclass(frozen=True)
class WorkerCleaner:
    """A cleaner that runs in the Python workers, such as a model.

    ``factory`` is a picklable callable, importable on the executors. It takes the options and
    returns a callable ``(list of tagged texts) -> list of texts``. It is called once per worker
    process, so a model is loaded once. It is asked for batches of texts of similar length, whose
    padded size is ``batch_tokens`` at most (a longer text is a batch of its own), counted by ``tokenizer``.
    """

    factory: Callable[[CleanOptions], Callable[[list[str]], list[str]]]
    options: CleanOptions = CleanOptions()
    batch_tokens: int = 1 << 14
    tokenizer: ByteTokenizer | WorkerTokenizer = BYTES

    def column(self, text: Column, lang: Column) -> Column:
        ship_package(SparkSession.active())
        loader, counter = pickle.dumps(_Loader(self.factory, self.options)), self.tokenizer.worker()
        budget = self.batch_tokens

        def clean(texts: pa.Array) -> pa.Array:
            from pairloom.operators.cleaning import clean_batch
            from pairloom.operators.tokenizers import worker_object

            return clean_batch(worker_object(loader), texts, worker_object(counter), budget)

        return F.arrow_udf(clean, StringType())(prefixed(lang, text))


@dataclass(frozen=True)
class _Loader:
    factory: Callable
    options: CleanOptions

    def __call__(self):
        return self.factory(self.options)


def dynamic_batches(sizes: Sequence[int], budget: int) -> Iterator[list[int]]:
    """Places of texts, the longest first, in batches whose longest text times their number is ``budget`` at most."""
    batch: list[int] = []
    for place in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        if batch and sizes[batch[0]] * (len(batch) + 1) > budget:
            yield batch
            batch = []
        batch.append(place)
    if batch:
        yield batch


def clean_batch(
    cleaner: Callable[[list[str]], list[str]], column: pa.Array, library: Any, budget: int, buffer: int = BUFFER
) -> pa.Array:
    """Null in, null out: the cleaner sees only texts it is meant to clean. The order of the rows is kept."""
    cleaned: list[str | None] = []
    for start in range(0, len(column), buffer):
        texts = column.slice(start, buffer).to_pylist()
        places = [i for i, t in enumerate(texts) if t is not None]
        out: list[str | None] = [None] * len(texts)
        for batch in dynamic_batches(count_batch(library, [texts[i] for i in places]), budget):
            asked = [places[i] for i in batch]
            answers = list(cleaner([texts[i] for i in asked]))
            if len(answers) != len(asked):
                raise ValueError(f"the cleaner gave {len(answers)} texts for {len(asked)}")
            for i, answer in zip(asked, answers):
                out[i] = answer
        cleaned += out
    return pa.array(cleaned, pa.string())


def _is_string(df: DataFrame, column: str) -> Column:
    if not isinstance(df.schema[column].dataType, StringType):
        return F.lit(False)
    return F.col(column).isNotNull()


def clean_status(
    df: DataFrame,
    languages: Sequence[str] = LANGUAGES,
    max_input: int = MAX_INPUT,
    text: str = "raw",
    lang: str = "lang",
    tokenizer=BYTES,
) -> DataFrame:
    """Add ``n_tokens`` (of the tagged text) and ``status``, what cleaning would do with the row.

    ``bad_text`` and ``bad_lang`` cannot be cleaned, ``empty`` stays empty, ``over_budget`` is
    refused and never cut, ``ok`` goes to the cleaner. White space alone is not empty.
    """
    n_tokens = tokenizer.count(prefixed(F.col(lang).cast("string"), F.col(text).cast("string")))
    status = (
        F.when(~_is_string(df, text), "bad_text")
        .when(~_is_string(df, lang) | ~F.col(lang).cast("string").isin(*languages), "bad_lang")
        .when(F.octet_length(F.col(text).cast("string")) == 0, "empty")
        .when(F.col("n_tokens") > max_input, "over_budget")
        .otherwise("ok")
    )
    return df.withColumn("n_tokens", n_tokens.cast("bigint")).withColumn("status", status)


def clean_texts(
    df: DataFrame,
    cleaner,
    languages: Sequence[str] = LANGUAGES,
    max_input: int = MAX_INPUT,
    text: str = "raw",
    lang: str = "lang",
    tokenizer=BYTES,
    on_reject: str = "status",
) -> DataFrame:
    """Add ``cleaned, n_tokens, status``; ``cleaned`` is null where the row is refused.

    ``on_reject='fail'`` makes the job fail at the first refused row instead.
    """
    if on_reject not in ("status", "fail"):
        raise ValueError(f"on_reject must be 'status' or 'fail', got {on_reject!r}")
    judged = clean_status(df, languages, max_input, text, lang, tokenizer)
    # null for all other rows: those do not reach the cleaner
    wanted = F.when(F.col("status") == "ok", F.col(text))
    cleaned = F.when(F.col("status") == "empty", F.lit("")).otherwise(
        strip_text(cleaner.column(wanted, F.col(lang)))
    )
    if on_reject == "fail":
        message = F.concat(F.lit("text refused: "), F.col("status"))
        refused = ~F.col("status").isin("ok", "empty")
        cleaned = F.when(refused, F.raise_error(message).cast("string")).otherwise(cleaned)
    return judged.withColumn("cleaned", cleaned)


def run_cases(
    cases: DataFrame, cleaner, languages: Sequence[str] = LANGUAGES, max_input: int = MAX_INPUT, tokenizer=BYTES
) -> DataFrame:
    """Clean a table of cases ``name, lang, raw, expect``; previews of both texts, side by side."""
    cleaned = clean_texts(cases, cleaner, languages, max_input, tokenizer=tokenizer)
    return cleaned.select(
        "name",
        "lang",
        "status",
        preview_text(F.col("raw"), 110).alias("raw_preview"),
        preview_text(F.col("cleaned"), 220).alias("clean_preview"),
        "expect",
    )
