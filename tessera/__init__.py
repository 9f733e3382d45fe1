"""Preparation of speech and text corpora on Spark: the public functions by area."""

from .functions import hashing, signal, text
from .operators import quality, relational
from .plans import stages
from .sources import io
from .streaming import incremental

__all__ = ["hashing", "incremental", "io", "quality", "relational", "signal", "stages", "text"]
