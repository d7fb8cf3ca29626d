from kpiloom.sources import chat, config, database, files, lines, reports

__all__ = ["chat", "config", "database", "files", "lines", "reports"]
