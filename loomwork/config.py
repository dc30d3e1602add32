"""Thresholds of all lanes as frozen dataclasses; echo() is what a lane writes beside its results."""

from __future__ import annotations

from dataclasses import asdict, dataclass


class Echo:
    def echo(self) -> dict:
        return asdict(self)


# Thresholds that results must agree on.


@dataclass(frozen=True)
class Extract(Echo):
    min_chars: int = 40
    min_alpha_percent: int = 45
    min_wordlike_percent: int = 60
    min_word_len_tenths: int = 25
    max_word_len_tenths: int = 90
    wordlike_max: int = 15
    ocr_invisible_min: float = 0.50
    ocr_sizes_min: int = 8
    born_invisible_max: float = 0.10
    born_sizes_max: int = 4
    full_page: float = 0.80
    figure: float = 0.05
    figure_words: int = 5
    blank_ink_max: float = 0.0008
    text_share_text: float = 0.90
    text_share_vision: float = 0.10
    marker: str = "[REDACTED]"
    page_chars: int = 2000
    bar_overlap: float = 0.50
    fully_redacted: float = 0.60
    class_text_chars: int = 50


@dataclass(frozen=True)
class Render(Echo):
    dpi: int = 200
    min_dpi: int = 36
    max_pixels: int = 40_000_000
    thumb: int = 512
    artifact_min_px: int = 64


@dataclass(frozen=True)
class Summarise(Echo):
    max_chars: int = 24_000
    batch: int = 40
    max_depth: int = 3
    in_usd: float = 0.10
    cached_usd: float = 0.025
    out_usd: float = 0.40
    batch_discount: float = 0.5
    dry_run_out: int = 160
    max_key_points: int = 8
    max_topics: int = 6


@dataclass(frozen=True)
class Vision(Echo):
    blank_max: float = 0.004
    black_min: float = 0.995
    in_usd: float = 0.25
    cached_usd: float = 0.025
    out_usd: float = 2.00
    page_in: int = 2490
    artifact_in: int = 1100
    page_out: int = 220
    artifact_out: int = 230


@dataclass(frozen=True)
class Chunk(Echo):
    parent_target: int = 500
    parent_max: int = 650
    child_target: int = 125
    child_max: int = 150


@dataclass(frozen=True)
class Embed(Echo):
    model: str = "text-embedding-3-small"
    dims: int = 1536
    batch: int = 32
    usd: float = 0.02
    shard_digits: int = 2


@dataclass(frozen=True)
class Ingest(Echo):
    severity: int = 4
    withhold_unvetted: bool = True
    placeholder_index: int = -1


@dataclass(frozen=True)
class Media(Echo):
    window_s: int = 120
    scene_min: int = 2
    max_frames: int = 120
    floor_s: int = 120
    floor_cap: int = 1800
    block: int = 4
    review: int = 2
    usd_per_minute: float = 0.003
    caption_chars: int = 12_000
    caption_frames: int = 8
