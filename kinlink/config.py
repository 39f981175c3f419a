"""Configuration: paths of a run, and the parameters of each stage. Plain Python, no Spark."""

from __future__ import annotations

import argparse
import os
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from pathlib import Path
from typing import Any

DEFAULT_ROOT = "file:///tmp/kinlink-data"
DEFAULT_NAMESPACE = "default"
#: Stages whose folders every namespace shares.
SHARED_STAGES = ("raw", "shared")
STAGES = (*SHARED_STAGES, "processed", "candidates", "features", "models", "reports", "experiments")


@dataclass(frozen=True)
class Paths:
    """Folders below ``root`` (any Hadoop file system): raw and shared ones are common, the others belong to a namespace."""

    root: str = DEFAULT_ROOT
    namespace: str = DEFAULT_NAMESPACE
    input_namespace: str | None = None

    def stage(self, name: str, namespace: str | None = None) -> str:
        if name not in STAGES:
            raise ValueError(f"unknown stage {name!r}; known: {', '.join(STAGES)}")
        inner = name if name in SHARED_STAGES else f"{namespace or self.namespace}/{name}"
        return f"{self.root.rstrip('/')}/{inner}/"

    def input_stage(self, name: str) -> str:
        """The folder that an earlier run, maybe in another namespace, has written."""
        return self.stage(name, self.input_namespace or self.namespace)

    def key(self, uri: str) -> str:
        """The part of a URI below the root; a URI elsewhere is an error."""
        root = self.root.rstrip("/") + "/"
        if not uri.startswith(root):
            raise ValueError(f"{uri!r} is not below {root!r}")
        return uri[len(root) :]

    def uri(self, key: str) -> str:
        return f"{self.root.rstrip('/')}/{key.lstrip('/')}"


@dataclass(frozen=True)
class BlockingConfig:
    """Candidate generation."""

    tfidf_top_k: int = 50
    ngram_min: int = 2
    ngram_max: int = 3
    min_similarity: float = 0.05
    token_sort_prefix_len: int = 5
    address_prefix_len: int = 8
    max_candidates_per_entity: int = 100

    @classmethod
    def from_mapping(cls, values: Mapping[str, Any]) -> BlockingConfig:
        """From a configuration section; ``ngram_size`` is the older name of ``ngram_max``; other keys are ignored."""
        known = {f.name for f in fields(cls)}
        renamed = {"ngram_max" if k == "ngram_size" else k: v for k, v in values.items()}
        return cls(**{k: v for k, v in renamed.items() if k in known})


@dataclass(frozen=True)
class NegativeSamplingConfig:
    """How many negatives are drawn for each positive of an entity, and from which scores."""

    hard_per_positive: int = 2
    easy_per_positive: int = 2
    hard_delta: float = 0.10
    easy_percentile: float = 0.30
    seed: int = 42

    @classmethod
    def from_mapping(cls, values: Mapping[str, Any]) -> NegativeSamplingConfig:
        known = {f.name for f in fields(cls)}
        return cls(**{k: v for k, v in values.items() if k in known})


@dataclass(frozen=True)
class PipelineConfig:
    paths: Paths = field(default_factory=Paths)
    sample_size: int = 10_000
    blocking: BlockingConfig = field(default_factory=BlockingConfig)
    sampling: NegativeSamplingConfig = field(default_factory=NegativeSamplingConfig)
    model: Mapping[str, Any] = field(default_factory=dict)
    validation: Mapping[str, Any] = field(default_factory=dict)
    threshold: Mapping[str, Any] = field(default_factory=dict)


def load_config(path: str | None = None, root: str | None = None, namespace: str | None = None) -> PipelineConfig:
    """Arguments go before the environment (``KINLINK_ROOT``, ``KINLINK_NAMESPACE``), that before the YAML file, that before defaults."""
    stored: dict[str, Any] = {}
    if path and Path(path).exists():
        import yaml

        stored = yaml.safe_load(Path(path).read_text()) or {}
    root = root or os.environ.get("KINLINK_ROOT") or stored.get("root") or DEFAULT_ROOT
    namespace = namespace or os.environ.get("KINLINK_NAMESPACE") or stored.get("namespace") or DEFAULT_NAMESPACE
    return PipelineConfig(
        paths=Paths(root, namespace, stored.get("input_namespace")),
        sample_size=int(stored.get("profiling", {}).get("sample_size", 10_000)),
        blocking=BlockingConfig.from_mapping(stored.get("blocking", {})),
        sampling=NegativeSamplingConfig.from_mapping(stored.get("sampling", {})),
        model=stored.get("model", {}),
        validation=stored.get("validation", {}),
        threshold=stored.get("threshold", {}),
    )


def add_arguments(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--config")
    parser.add_argument("--root")
    parser.add_argument("--namespace")


def config_from_arguments(args: argparse.Namespace) -> PipelineConfig:
    return load_config(args.config, args.root, args.namespace)
