"""Job parameters. Plain values only; nothing here touches Spark."""

from dataclasses import dataclass, field, fields
from collections.abc import Mapping

from goldquarry import fixed_values as fv


@dataclass(frozen=True)
class JobParams:
    """Row limits use 0 for "all rows" everywhere."""

    artifact_dir: str = "artifacts"
    annotator: str = fv.ANNOTATORS[0]
    annotation_model: str = fv.ANNOTATION_MODEL
    models: tuple[str, ...] = (fv.SCORING_MODEL,)
    max_curation_rows: int = 0
    max_augmentation_rows: int = 0
    max_eval_rows: int = 0
    # Buckets that kept answers are dealt to by request; a folder keeps its number.
    answer_buckets: int = 32
    force_refresh: bool = False
    coverage_min_count: int = fv.COVERAGE_MIN_COUNT
    n_queries: int = fv.QUERY_COUNT
    n_samples: int = fv.QUERY_SAMPLES
    seed: int = fv.SAMPLE_SEED
    ranges: Mapping = field(default_factory=lambda: dict(fv.QUALITY_RANGES))
    exclusions: Mapping = field(default_factory=lambda: dict(fv.QUALITY_EXCLUSIONS))

    def __post_init__(self):
        if self.annotator not in fv.ANNOTATORS:
            known = ", ".join(sorted(fv.ANNOTATORS))
            raise ValueError(f"Unsupported annotator {self.annotator!r}; known: {known}")

    @classmethod
    def from_mapping(cls, values: Mapping[str, str]) -> "JobParams":
        """Build from string settings such as environment variables or job arguments.

        Keys are field names in any case; integers and booleans ("1", "true") are converted.
        """
        kinds = {f.name: f.type for f in fields(cls)}
        given = {}
        for key, value in values.items():
            name = key.lower()
            if name not in kinds:
                continue
            if kinds[name] in (int, "int"):
                given[name] = int(value)
            elif kinds[name] in (bool, "bool"):
                given[name] = str(value).strip().lower() in ("1", "true")
            elif name == "models":
                given[name] = tuple(m.strip() for m in value.split(",") if m.strip())
            elif name == "annotator":
                given[name] = value.strip().lower()
            else:
                given[name] = value
        return cls(**given)
