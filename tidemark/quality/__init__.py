from tidemark.quality.rules import Rule, evaluate, fact_violations, suite_summary  # noqa: F401
