"""All registered queries and their SQL."""

from registry import clauses, core, datasets, model, quality, storage  # noqa: F401
