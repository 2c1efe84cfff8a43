"""All checked queries. Importing the modules registers them."""

from checks import model_checks, table_checks, text_checks, vector_checks  # noqa: F401
from checks.base import ORACLES, QUERIES  # noqa: F401
