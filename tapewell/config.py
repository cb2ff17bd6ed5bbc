"""Feed declaration: which venues, symbols and channels a lake is built from."""

from __future__ import annotations

import json
from dataclasses import dataclass, field

# Venues, native symbol styles and native channel names.
DEFAULT_SYMBOLS = ("BTC-USD", "ETH-USD", "SOL-USD")
DEFAULT_CHANNELS = ("trades", "ticker")
COINBASE_CHANNELS = {"trades": "market_trades", "ticker": "ticker", "level2": "level2"}
BINANCE_US_CHANNELS = {"trades": "trade", "ticker": "bookTicker", "level2": "depth"}

# Topic names.
TRADES_TOPIC = "trades.raw"
TICKER_TOPIC = "ticker.raw"
WINDOWS_TOPIC = "metrics.windowed"
QUARANTINE_TOPIC = "contracts.quarantine"

SYMBOL_STYLES = ("dash", "concat")


@dataclass(frozen=True)
class Venue:
    """How one exchange spells symbols and channels."""

    symbol_style: str = "dash"
    channel_map: dict[str, str] = field(default_factory=dict)

    def native_channel(self, channel: str) -> str:
        return self.channel_map.get(channel, channel)


@dataclass(frozen=True)
class FeedConfig:
    """Active venue, the symbols and channels followed, and all known venues."""

    exchange: str
    symbols: tuple[str, ...]
    channels: tuple[str, ...]
    exchanges: dict[str, Venue]

    def __post_init__(self) -> None:
        for name in ("symbols", "channels"):
            if not getattr(self, name):
                raise ValueError(f"{name} must be non-empty")

    @property
    def venue(self) -> Venue:
        if self.exchange not in self.exchanges:
            raise ValueError(
                f"exchange {self.exchange!r} is not declared; known: {sorted(self.exchanges)}"
            )
        return self.exchanges[self.exchange]


def default_feed() -> FeedConfig:
    return FeedConfig(
        exchange="coinbase",
        symbols=DEFAULT_SYMBOLS,
        channels=DEFAULT_CHANNELS,
        exchanges={
            "coinbase": Venue("dash", dict(COINBASE_CHANNELS)),
            "binance_us": Venue("concat", dict(BINANCE_US_CHANNELS)),
        },
    )


def load_feed(path: str) -> FeedConfig:
    """Read a feed declaration from JSON, or from YAML where PyYAML is installed."""
    with open(path, encoding="utf-8") as handle:
        text = handle.read()
    if path.endswith((".yaml", ".yml")):
        try:
            import yaml
        except ImportError as exc:
            raise RuntimeError("PyYAML is needed for YAML feed files; use JSON instead") from exc
        raw = yaml.safe_load(text)
    else:
        raw = json.loads(text)
    return FeedConfig(
        exchange=raw["exchange"],
        symbols=tuple(raw["symbols"]),
        channels=tuple(raw["channels"]),
        exchanges={
            name: Venue(v.get("symbol_style", "dash"), dict(v.get("channel_map", {})))
            for name, v in raw["exchanges"].items()
        },
    )
