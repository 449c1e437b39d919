"""Document profiles: what a kind of document knows about headings, regions and metadata, as Column expressions.

A new kind of document subclasses Profile and registers under a key. Nothing of a profile runs as Python on executors.
"""

from __future__ import annotations

from abc import ABC, abstractmethod
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A heading that a line was found to be; null if it is none.
HEADING = "struct<kind: string, number: string, title: string, level: int>"


class Profile(ABC):
    """Expressions over text (as it stands on the page), visual (boolean) and other columns of lines."""

    @property
    @abstractmethod
    def document_type(self) -> str: ...

    @abstractmethod
    def heading(self, text: Column, visual: Column) -> Column:
        """A HEADING struct, or null."""

    @abstractmethod
    def region(self, text: Column) -> Column:
        """toc, references or appendices for the line that begins such a region, else null."""

    @abstractmethod
    def named_id(self, title: Column) -> Column: ...

    @abstractmethod
    def metadata(self, texts: DataFrame, registry: DataFrame | None) -> DataFrame: ...

    def continuation(self, text: Column) -> Column:
        """What a line says about continuing an open title, whatever the title (see operators.fold): here, that it never does."""
        return F.struct(F.lit(False).alias("may"), F.lit(False).alias("always"), F.lit(False).alias("at_top"), F.lit(False).alias("closes"))

    def attaches(self, title: Column, visual: Column, number: Column, level: Column) -> Column:
        """Whether a line (or lines joined) can be the title of a number that stands alone."""
        return F.coalesce(title, F.lit("")) != ""

    def parts(self, text: Column) -> Column:
        """The lines that a line with hidden headings falls into."""
        return F.array(text)


_PROFILES: dict[str, Callable[[], Profile]] = {}


def register(key: str, make: Callable[[], Profile]) -> None:
    _PROFILES[key] = make


def available_profiles() -> list[str]:
    return sorted(_PROFILES)


def create_profile(key: str) -> Profile:
    if key not in _PROFILES:
        raise ValueError(f"unknown profile {key!r}; there are {', '.join(available_profiles())}")
    return _PROFILES[key]()
