from kpiloom.sinks import tables

__all__ = ["tables"]
