"""The catalogue: seven related DataFrames addressed by table name."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import DataFrame

# Table names as they appear in file stems (dotted) and as SQL views (underscored).
TABLES = (
    "name.basics",
    "title.akas",
    "title.basics",
    "title.crew",
    "title.episode",
    "title.principals",
    "title.ratings",
)


def view_name(table: str) -> str:
    return table.replace(".", "_")


class MissingTableError(KeyError):
    pass


class Catalog(Mapping):
    """Immutable mapping ``table name -> DataFrame`` with attribute access.

    ``cat.title_basics`` and ``cat["title.basics"]`` are the same frame.
    Tables that failed to load are listed in ``missing`` and raise a
    ``MissingTableError`` naming the table when a question touches them.
    A table may be given as a zero-argument function returning the frame;
    it is built on first use, so a question only pays for the plans of the
    tables it reads. Further tables may be held under any name; they get
    views and profiles like the seven.
    """

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]],
                 missing: Mapping[str, str] | None = None):
        self._frames = {self._canon(k): v for k, v in frames.items()}
        self.missing = dict(missing or {})

    @staticmethod
    def _canon(name: str) -> str:
        """The dotted name of one of the seven tables; any other name as it is."""
        dotted = name.replace("_", ".", 1)
        return dotted if "." not in name and dotted in TABLES else name

    def __getitem__(self, name: str) -> DataFrame:
        key = self._canon(name)
        if key not in self._frames and key not in TABLES and key not in self.missing:
            raise KeyError(f"unknown catalogue table {name!r}; known: {sorted({*TABLES, *self._frames})}")
        if key not in self._frames:
            why = self.missing.get(key, "not loaded")
            raise MissingTableError(f"catalogue table {key!r} is unavailable: {why}")
        frame = self._frames[key]
        if not isinstance(frame, DataFrame):
            frame = self._frames[key] = frame()
        return frame

    def __getattr__(self, attr: str) -> DataFrame:
        if attr.startswith("_"):
            raise AttributeError(attr)
        try:
            return self[attr]
        except MissingTableError:
            raise
        except KeyError as exc:
            raise AttributeError(str(exc)) from None

    def __iter__(self) -> Iterator[str]:
        return iter(self._frames)

    def __len__(self) -> int:
        return len(self._frames)

    def __repr__(self) -> str:
        loaded = ", ".join(sorted(self._frames)) or "none"
        missing = f"; missing: {', '.join(sorted(self.missing))}" if self.missing else ""
        return f"Catalog(tables: {loaded}{missing})"

    def replace(self, **frames: DataFrame) -> "Catalog":
        """A new catalogue with some tables swapped (e.g. persisted copies)."""
        merged = dict(self._frames)
        for key, df in frames.items():
            merged[self._canon(key)] = df
        return Catalog(merged, self.missing)

    def persisted(self, storage_level=None, tables=None) -> "Catalog":
        """A catalogue whose tables (all, or ``tables``) are persisted when
        first computed (default MEMORY_AND_DISK, so partitions that do not
        fit in memory spill instead of being recomputed). Opt-in: worth it
        when many questions run over the same session and the tables fit
        the cluster's storage memory; ``unpersist`` releases them."""
        from pyspark import StorageLevel
        level = storage_level or StorageLevel.MEMORY_AND_DISK
        chosen = {self._canon(t) for t in tables} if tables else set(self._frames)
        return Catalog({k: (self[k].persist(level) if k in chosen else self._frames[k])
                        for k in self._frames}, self.missing)

    def unpersist(self) -> None:
        for key, frame in self._frames.items():
            if isinstance(frame, DataFrame):
                frame.unpersist()

    def register_views(self) -> list[str]:
        """Expose every table as a temp view (dots become underscores) so
        ``spark.sql`` can query the catalogue."""
        names = []
        for key, df in self.items():
            df.createOrReplaceTempView(view_name(key))
            names.append(view_name(key))
        return names
