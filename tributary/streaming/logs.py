"""JSON logging."""

from __future__ import annotations

import json
import logging
import sys

LEVELS = {"error": logging.ERROR, "warn": logging.WARNING, "info": logging.INFO, "debug": logging.DEBUG, "trace": logging.DEBUG}


class JsonFormatter(logging.Formatter):
    def format(self, record: logging.LogRecord) -> str:
        body = {"time": self.formatTime(record), "level": record.levelname.lower(), "msg": record.getMessage()}
        body |= getattr(record, "fields", {})
        if record.exc_info:
            body["error"] = self.formatException(record.exc_info)
        return json.dumps(body, default=str)


def get_logger(level: str = "info", name: str = "tributary") -> logging.Logger:
    """The library's logger at a level; unknown levels are an error."""
    if level.lower() not in LEVELS:
        raise ValueError(f"unknown log level: {level}")
    logger = logging.getLogger(name)
    if not logger.handlers:
        handler = logging.StreamHandler(sys.stderr)
        handler.setFormatter(JsonFormatter())
        logger.addHandler(handler)
        logger.propagate = False
    logger.setLevel(LEVELS[level.lower()])
    return logger
