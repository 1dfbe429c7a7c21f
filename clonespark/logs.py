"""Log records of many processes in one place."""

from __future__ import annotations

import logging
from logging.config import fileConfig
from logging.handlers import QueueHandler, QueueListener


def send_to(queue, name: str | None = None, level: int = logging.INFO) -> logging.Logger:
    """A logger whose records go to the queue."""
    out = logging.getLogger(name)
    out.setLevel(level)
    if not any(isinstance(h, QueueHandler) and h.queue is queue for h in out.handlers):
        out.addHandler(QueueHandler(queue))
    return out


class _ByName(logging.Handler):
    """Hands records to the loggers that they name, as set up here."""

    def emit(self, record: logging.LogRecord) -> None:
        logging.getLogger(record.name).handle(record)


def listen(queue, config_file: str | None = None) -> QueueListener:
    """Starts to handle the queue's records as a logging configuration file says; stop() ends it. Spark's own logs aren't concerned."""
    if config_file:
        fileConfig(config_file, disable_existing_loggers=False)
    out = QueueListener(queue, _ByName())
    out.start()
    return out
