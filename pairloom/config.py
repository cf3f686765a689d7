"""Job parameters. They are checked on the driver before any job starts."""

from __future__ import annotations

import math
from dataclasses import dataclass

# They must equal the values a prepared corpus is read back with.
LANGUAGES = ("id", "en", "zh")
PAIR_COLUMNS = ("lang", "raw", "clean")
TOKEN_COLUMNS = ("input_ids", "labels")
IGNORED_LABEL = -100
PAD_MULTIPLE = 8
PREPARE_VERSION = 3
MAX_INPUT = 4096
MAX_TARGET = 512
FULL_CORPUS_ROWS = 1_431_369
# what becomes of pairs over a budget
OVERSIZED = ("truncate", "skip", "chunk")


def _positive_int(name: str, value: object) -> None:
    # bool is an int in Python but not a count
    if type(value) is not int or value <= 0:
        raise ValueError(f"{name} must be a positive integer, got {value!r}")


@dataclass(frozen=True)
class PrepareConfig:
    """Parameters of a prepare run."""

    languages: tuple[str, ...] = LANGUAGES
    max_input: int = MAX_INPUT
    max_target: int = MAX_TARGET
    oversized: str = "truncate"
    val_frac: float = 0.01
    val_max: int = 4000
    seed: int = 42
    batch: int = 2
    mega: int = 50

    def __post_init__(self) -> None:
        for name in ("max_input", "max_target", "val_max", "batch", "mega"):
            _positive_int(name, getattr(self, name))
        if not math.isfinite(self.val_frac) or not 0 < self.val_frac < 1:
            raise ValueError(f"val_frac must lie strictly between 0 and 1, got {self.val_frac!r}")
        if self.oversized not in OVERSIZED:
            raise ValueError(f"oversized must be one of {', '.join(OVERSIZED)}, got {self.oversized!r}")
        if not self.languages:
            raise ValueError("languages must not be empty")


@dataclass(frozen=True)
class CleanOptions:
    """Generation options, handed unchanged to the cleaner's factory."""

    max_new_tokens: int = 4096
    num_beams: int = 1
    min_new_tokens: int = 0
    repetition_penalty: float = 1.0
    no_repeat_ngram: int = 0

    def __post_init__(self) -> None:
        _positive_int("max_new_tokens", self.max_new_tokens)
        _positive_int("num_beams", self.num_beams)
        if type(self.min_new_tokens) is not int or not 0 <= self.min_new_tokens <= self.max_new_tokens:
            raise ValueError("min_new_tokens must be an integer between 0 and max_new_tokens")
        if type(self.no_repeat_ngram) is not int or self.no_repeat_ngram < 0:
            raise ValueError("no_repeat_ngram must be an integer of at least 0")
        penalty = self.repetition_penalty
        if type(penalty) not in (int, float) or not math.isfinite(penalty) or penalty <= 0:
            raise ValueError("repetition_penalty must be a finite number above 0")
