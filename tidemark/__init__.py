"""tidemark: data-trust and incident analytics as Spark DataFrame operators."""

from tidemark.session import configure, materialize

__all__ = ["configure", "materialize"]
