"""Parameters of one modelling run."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class ModelSpec:
    """What to model and how.

    target          binary target column
    keys            columns that together identify a row; they drive splits and ties
    positive_label  value of ``target`` that counts as 1
    exclude_patterns, use_patterns
                    columns whose name contains one of these (case-insensitive
                    regular expressions) are left out while ``use_patterns`` is on
    exclude         column names left out, case-insensitive
    max_levels      string columns with this many distinct values or more are dropped
    train_fraction, seed
                    share of rows used for fitting, and the seed of the split
    fit_scope       'train': fill values, encoders and scalers see training rows only;
                    'all': they see every row
    """

    target: str
    keys: tuple[str, ...]
    positive_label: object = 1
    exclude_patterns: tuple[str, ...] = ()
    use_patterns: bool = True
    exclude: tuple[str, ...] = ()
    max_levels: int = 20
    train_fraction: float = 0.7
    seed: int = 42
    fit_scope: str = "train"
    unknown: str = field(default="Unknown_Value")

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError("keys must name the columns that identify a row")
        if self.fit_scope not in ("train", "all"):
            raise ValueError("fit_scope is 'train' or 'all'")
        if not 0 < self.train_fraction < 1:
            raise ValueError("train_fraction lies between 0 and 1")
