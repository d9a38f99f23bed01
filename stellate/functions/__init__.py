from .dates import date_parts, epoch_days_to_date, season, to_date_part
from .geo import location_label, parse_hemisphere, split_coordinates
from .similarity import edit_score, normalise, token_score, tokens
from .text import (
    clean_label,
    label_is,
    override_by_keyword,
    parse_number,
    part_at,
    remove_tokens,
    replace_all,
    split_code_label,
    strip_blanks,
    strip_chars,
    title_case,
)

__all__ = [
    "clean_label",
    "date_parts",
    "edit_score",
    "epoch_days_to_date",
    "label_is",
    "location_label",
    "normalise",
    "override_by_keyword",
    "parse_hemisphere",
    "parse_number",
    "part_at",
    "remove_tokens",
    "replace_all",
    "season",
    "split_code_label",
    "split_coordinates",
    "strip_blanks",
    "strip_chars",
    "title_case",
    "to_date_part",
    "token_score",
    "tokens",
]
