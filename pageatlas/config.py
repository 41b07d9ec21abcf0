"""Design constants of the stages, in one strict, frozen structure. The names and defaults are fixed values."""

from __future__ import annotations

import dataclasses
from dataclasses import dataclass, field
from typing import Any


@dataclass(frozen=True)
class Crawl:
    concurrency: int = 20
    host_delay: float = 1.0
    max_bytes: int = 5_000_000
    failure_threshold: float = 0.30


@dataclass(frozen=True)
class Extract:
    min_text_chars: int = 200
    meaningful_ratio: float = 0.98


@dataclass(frozen=True)
class Enrich:
    domains: tuple[str, ...] = ("work", "family", "health", "learning", "creative", "place", "community", "rest", "other")
    statuses: tuple[str, ...] = ("starting", "ongoing", "ending")
    life_transitions: tuple[str, ...] = ("moved", "new_child", "left_job", "new_job", "sabbatical", "loss", "illness", "other")
    sensitive_topics: tuple[str, ...] = ("health", "sexuality", "religion", "politics", "finances")
    prompt_version: str = "1"
    max_text_chars: int = 12_000
    max_focuses: int = 5
    max_quotes: int = 3
    summary_words: int = 25
    concurrency: int = 8
    checkpoint_every: int = 25

    def __post_init__(self):
        if "other" not in self.domains:
            raise ValueError("domains need 'other'")


@dataclass(frozen=True)
class Embed:
    model: str = "sentence-mini-64"
    max_tokens: int = 128


@dataclass(frozen=True)
class Cluster:
    min_cluster_size: int = 8
    min_topic_pages: int = 3
    merge_cosine: float = 0.85
    label_terms: int = 3
    label_max_page_share: float = 0.4
    topic_sample_size: int = 10
    excerpt_chars: int = 280


@dataclass(frozen=True)
class Tuning:
    crawl: Crawl = field(default_factory=Crawl)
    extract: Extract = field(default_factory=Extract)
    enrich: Enrich = field(default_factory=Enrich)
    embed: Embed = field(default_factory=Embed)
    cluster: Cluster = field(default_factory=Cluster)

    @classmethod
    def from_dict(cls, given: dict[str, dict[str, Any]]) -> Tuning:
        """Defaults overlaid by ``given``; an unknown section or key is an error."""
        sections = {f.name: f.default_factory for f in dataclasses.fields(cls)}
        out = {}
        for name, values in given.items():
            if name not in sections:
                raise ValueError(f"unknown section {name!r}")
            allowed = {f.name for f in dataclasses.fields(sections[name])}
            if unknown := set(values) - allowed:
                raise ValueError(f"unknown keys in {name}: {sorted(unknown)}")
            out[name] = sections[name](**{k: tuple(v) if isinstance(v, list) else v for k, v in values.items()})
        return cls(**out)
