from .url import (ALL_FEATURE_COLUMNS, NUMERIC_FEATURES, TEXT_FEATURES, display_name,
                  with_text_features, with_url_features, with_url_parts)

__all__ = ["ALL_FEATURE_COLUMNS", "NUMERIC_FEATURES", "TEXT_FEATURES", "display_name",
           "with_text_features", "with_url_features", "with_url_parts"]
