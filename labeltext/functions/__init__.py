"""Column expressions."""

from labeltext.functions.arrays import arg_max, keep_last, pad_sequence, ranked, softmax
from labeltext.functions.text import (
    as_text,
    clean_text,
    clean_tokens,
    code_pattern,
    is_blank,
    label_of,
    mentions,
    remove_stop_words,
    tokenize_keras,
    tokenize_words,
    unescape_html,
    word_count,
)

__all__ = [
    "arg_max", "as_text", "clean_text", "clean_tokens", "code_pattern", "is_blank",
    "keep_last", "label_of", "mentions", "pad_sequence", "ranked", "remove_stop_words",
    "softmax", "tokenize_keras", "tokenize_words", "unescape_html", "word_count",
]
