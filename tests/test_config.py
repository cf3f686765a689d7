import math

import pytest

from pairloom.config import CleanOptions, PrepareConfig


@pytest.mark.parametrize(
    "wrong",
    [
        {"val_frac": 0.0}, {"val_frac": 1.0}, {"val_frac": math.nan}, {"val_frac": math.inf}, {"val_max": 0},
        {"batch": 0}, {"batch": True}, {"mega": -1}, {"max_input": 0}, {"max_target": 1.5}, {"oversized": "cut"},
        {"languages": ()},
    ],
)
def test_prepare_parameters_are_checked(wrong):
    with pytest.raises(ValueError):
        PrepareConfig(**wrong)


@pytest.mark.parametrize(
    "wrong",
    [
        {"max_new_tokens": 0}, {"max_new_tokens": True}, {"num_beams": 0}, {"min_new_tokens": -1},
        {"min_new_tokens": 5000}, {"no_repeat_ngram": -1}, {"repetition_penalty": 0},
        {"repetition_penalty": math.inf}, {"repetition_penalty": "1"},
    ],
)
def test_clean_options_are_checked(wrong):
    with pytest.raises(ValueError):
        CleanOptions(**wrong)


def test_defaults_are_valid():
    assert PrepareConfig().max_input == 4096 and PrepareConfig().max_target == 512
    assert CleanOptions(min_new_tokens=4096, repetition_penalty=2).num_beams == 1
