"""All settings of the jobs in one validated, immutable record."""

from __future__ import annotations

from dataclasses import dataclass

# Defaults and names users of the original job rely on.
SET_NAMES = ("Training", "Test", "Validation")
UNDEFINED_DOMAIN = "undefined_domain"
IDF_ALGORITHM = "idfModel"


@dataclass(frozen=True)
class Options:
    """Settings shared by the preparation and the mining jobs.

    ``lower_case`` acts inside the normaliser, so it has no effect unless
    ``normalize`` is set. ``fit_on`` decides whether the bag vocabulary and the
    IDF weights come from every post or from the training posts only. Rules need
    ``support_count`` training posts, or the share ``min_support`` if that is set.
    ``max_antecedent`` bounds the items on the left of a label rule; None does not.
    """

    training_share: float = 0.6
    test_share: float = 0.3
    validation_share: float = 0.1
    fraction_of_tags: float = 1.0
    seed: int = 0
    output_format: str = "parquet"
    rows_per_shard: int = 1_000_000
    max_records_per_file: int = 1_000_000
    token_usage_threshold: int = 5
    vocab_size: int = 100
    ngrams: int = 0
    min_df: int = 10
    algorithm: str = IDF_ALGORITHM
    combine: bool = True
    normalize: bool = False
    lower_case: bool = False
    stem: bool = False
    fit_on: str = "all"
    keep_punct: bool = False
    dotall: bool = False
    hash_method: str = "xxhash64"
    label_cap: int = 100
    min_confidence: float = 0.7
    support_count: int = 20
    min_support: float | None = None
    max_antecedent: int | None = None

    def __post_init__(self) -> None:
        def check(ok: bool, message: str) -> None:
            if not ok:
                raise ValueError(message)

        shares = (self.training_share, self.test_share, self.validation_share)
        check(all(0 <= s <= 1 for s in shares), "shares must lie in [0, 1]")
        check(abs(sum(shares) - 1) < 1e-9, "shares must add up to 1")
        check(0 < self.fraction_of_tags <= 1, "fraction_of_tags must lie in (0, 1]")
        check(self.output_format in ("parquet", "csv"), "output_format: parquet or csv")
        check(self.rows_per_shard > 0 and self.max_records_per_file > 0, "shards and files must have rows")
        check(self.token_usage_threshold >= 0, "token_usage_threshold must not be negative")
        check(self.vocab_size > 0, "vocab_size must be positive")
        check(self.ngrams >= 0, "ngrams must not be negative")
        check(self.min_df >= 1, "min_df must be at least 1")
        check(self.fit_on in ("all", "training"), "fit_on: all or training")
        check(self.hash_method in ("xxhash64", "murmur3_128"), "hash_method: xxhash64 or murmur3_128")
        check(self.label_cap > 0 and self.support_count > 0, "caps and supports must be positive")
        check(0 < self.min_confidence <= 1, "min_confidence must lie in (0, 1]")
        check(self.min_support is None or 0 < self.min_support <= 1, "min_support must lie in (0, 1]")
        check(self.max_antecedent is None or self.max_antecedent > 0, "max_antecedent must be positive")

    @property
    def test_bound(self) -> float:
        """Upper end of the test share on the [0, 1) draw."""
        return self.training_share + self.test_share
