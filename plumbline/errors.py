"""Typed errors, so a caller can tell bad settings, bad data and bad models apart."""


class PlumblineError(Exception):
    """Base of every error this library raises on purpose."""


class ConfigError(PlumblineError):
    """A setting or argument is missing, malformed or out of range."""


class DataError(PlumblineError):
    """A dataset is missing, unreadable, or breaks a stated rule."""


class ModelError(PlumblineError):
    """A model is missing, unreadable, or does not fit the data it is given."""
