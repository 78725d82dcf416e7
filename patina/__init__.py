"""patina: profile, synthesise, corrupt and audit tables as Spark jobs."""

from patina.collection import Collection

__all__ = ["Collection"]
