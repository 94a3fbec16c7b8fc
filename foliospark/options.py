"""All thresholds in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Options:
    page_chars: int = 50
    window_after_start: tuple[int, int] = (1, 6)
    pages_after_header: int = 4
    last_pages: int = 25
    guess_first: int = 15
    guess_middle: tuple[int, int] = (35, 65)
    guess_middle_from: int = 31
    guess_last: int = 30
    key_prefix: int = 100
    surplus_cap: int = 300
    surplus_cut_after: int = 50
    line_gap: int = 15
    word_confidence: int = 20
    column_share: float = 0.15
    dpi: int = 200
    retry_dpis: tuple[int, ...] = (150, 250, 300)
    enhanced_dpi: int = 400
    company_number: str = r"^([A-Z]{2}\d{6}|\d{6,8})"


DEFAULT = Options()
