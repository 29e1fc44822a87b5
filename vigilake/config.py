"""Settings and secrets. Secrets come from a provider that the caller gives; they are never printed."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Protocol


class ConfigError(ValueError):
    """A setting is missing or out of range."""


class SecretProvider(Protocol):
    def get(self, scope: str, key: str) -> str | None: ...


class EnvSecrets:
    """Secrets from environment variables SCOPE__KEY, in capitals, with other characters as underscores."""

    def __init__(self, env: Mapping[str, str] | None = None):
        self._env = os.environ if env is None else env

    def get(self, scope: str, key: str) -> str | None:
        name = "".join(c if c.isalnum() else "_" for c in f"{scope}__{key}").upper()
        return self._env.get(name)


@dataclass(frozen=True)
class KafkaConfig:
    bootstrap_servers: str
    topic: str
    api_key: str = field(repr=False, default="")
    api_secret: str = field(repr=False, default="")

    @classmethod
    def from_secret(cls, secrets: SecretProvider, scope: str, key: str) -> KafkaConfig:
        """The secret is JSON text with bootstrap_servers, api_key, api_secret and topic."""
        raw = secrets.get(scope, key)
        if raw is None:
            raise ConfigError(f"no secret {key} in scope {scope}")
        try:
            found = json.loads(raw)
            return cls(found["bootstrap_servers"], found["topic"], found["api_key"], found["api_secret"])
        except (ValueError, KeyError, TypeError):
            raise ConfigError(f"secret {key} in scope {scope} must be JSON with bootstrap_servers, topic, api_key and api_secret") from None


@dataclass(frozen=True)
class SimulatorSettings:
    """What the simulator makes, and how fast."""

    transactions_per_second: float = 5.0
    fraud_percentage: float = 0.08
    customers: int = 1000
    merchants: int = 200
    seed: int = 42

    def __post_init__(self):
        if not self.transactions_per_second > 0:
            raise ConfigError("transactions_per_second must be above 0")
        if not 0 <= self.fraud_percentage <= 1:
            raise ConfigError("fraud_percentage must be from 0 to 1")
        if self.customers <= 0 or self.merchants <= 0:
            raise ConfigError("customers and merchants must be above 0")

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> SimulatorSettings:
        """TRANSACTIONS_PER_SECOND, FRAUD_PERCENTAGE, CUSTOMER_COUNT, MERCHANT_COUNT and RANDOM_SEED, where set."""
        env = os.environ if env is None else env
        names = (("transactions_per_second", float), ("fraud_percentage", float), ("customers", int), ("merchants", int), ("seed", int))
        keys = ("TRANSACTIONS_PER_SECOND", "FRAUD_PERCENTAGE", "CUSTOMER_COUNT", "MERCHANT_COUNT", "RANDOM_SEED")
        given = {}
        for (name, kind), key in zip(names, keys):
            if env.get(key):
                try:
                    given[name] = kind(env[key])
                except ValueError:
                    raise ConfigError(f"{key} must be a number") from None
        return cls(**given)
