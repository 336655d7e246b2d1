from graustein.functions.ebkp import is_code, main_code, normalize_code, parent_code
from graustein.functions.ids import (
    element_uid, project_from_filename, surrogate_key, url_bucket, url_object,
)
from graustein.functions.numbers import (
    is_missing, not_positive, swiss_number, to_number, value_problem, zero_if_missing,
)

__all__ = [
    "is_code", "main_code", "normalize_code", "parent_code", "element_uid",
    "project_from_filename", "surrogate_key", "url_bucket", "url_object", "is_missing",
    "not_positive", "swiss_number", "to_number", "value_problem", "zero_if_missing",
]
