"""Where each dataset lives in the three storage zones."""

from __future__ import annotations

import os
from dataclasses import dataclass

# Dataset names shared by all zones.
AWARDS = "awards"
TERMINATED = "terminated"
REVIEW_LIST = "review_list"
LEGISLATORS = "legislators"
LEXICON = "lexicon"
DATASETS = (AWARDS, TERMINATED, REVIEW_LIST, LEGISLATORS, LEXICON)


@dataclass(frozen=True)
class Zones:
    """Paths below one lake root; any Hadoop-readable URI works."""

    root: str
    fmt: str = "parquet"

    @classmethod
    def from_env(cls) -> "Zones":
        root = os.environ.get("RISKMART_ROOT")
        if not root:
            raise ValueError("set RISKMART_ROOT to the lake's root, a path that all executors share")
        return cls(root, os.environ.get("RISKMART_FORMAT", "parquet"))

    def landing(self, dataset: str) -> str:
        return f"{self.root}/landing/{dataset}"

    def formatted(self, dataset: str) -> str:
        return f"{self.root}/formatted/{dataset}"

    def rejects(self, step: str, dataset: str) -> str:
        return f"{self.root}/rejects/{step}/{dataset}"

    @property
    def exploitation(self) -> str:
        return f"{self.root}/exploitation/grants"

    @property
    def runs(self) -> str:
        return f"{self.root}/exploitation/runs"

    @property
    def predictions(self) -> str:
        return f"{self.root}/exploitation/predictions"

    @property
    def models(self) -> str:
        return f"{self.root}/exploitation/models"

    @property
    def reports(self) -> str:
        return f"{self.root}/exploitation/reports"
