from .clean import conform, declared_type, scrub_delims, table_of_file
from .keys import normalise_key

__all__ = ["conform", "declared_type", "normalise_key", "scrub_delims", "table_of_file"]
