"""URL verdicts: host and path rules first, else a logistic regression on character n-grams.

Features are character n-grams of 3 to 5 of the host and of the path, each hashed with its
part's name into BUCKETS places, with the vector scaled to length 1. The regression is
trained on the small labelled table LABELLED by full-batch gradient steps from zero, so
every run gives the same weights.

Contract of judge(): host is what follows the first :// up to / ? # or the end, A-Z lower-
cased; path follows up to ? # or the end. Null urls and those without :// have both empty.
A rule fits its host and all its subdomains where the path starts with the rule's path;
the longest fitting rule gives rule and verdict; otherwise rule is null and the method
decides. Rows map one to one; columns named like an output give way to it.
"""

from __future__ import annotations

import zlib
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame

from weftlink.llm.common import append_columns

BUCKETS = 1 << 14
SIZES = (3, 4, 5)
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]

#: The labelled URLs: 1 is to be blocked.
LABELLED = [
    (1, "http://cheap-pills.example.com/buy-now"), (1, "https://best-pills-online.example.net/order/viagra"), (1, "http://online-casino.example.com/bonus/slots"),
    (1, "https://casino-royal.example.net/free-spins"), (1, "http://spam-farm.example.org/links/1"), (1, "https://link-farm.example.com/seo/backlinks"),
    (1, "http://free-money.example.net/click-here"), (1, "https://hot-singles.example.com/adult/chat"), (1, "http://xxx-videos.example.net/porn/1"),
    (1, "https://adult-cams.example.com/live"), (1, "http://crack-warez.example.org/download/keygen.exe"), (1, "https://torrent-warez.example.net/serial-keys"),
    (1, "http://payday-loans.example.com/apply?ref=spam"), (1, "https://fast-loans.example.net/no-credit-check"), (1, "http://replica-watches.example.com/cheap-rolex"),
    (1, "https://cheap-handbags.example.net/replica/sale"), (1, "http://secure-login-verify.example.com/account/update"), (1, "https://bank-login-alert.example.net/verify/password"),
    (1, "http://get-rich-quick.example.com/forex-signals"), (1, "https://bet-win.example.net/sportsbook/bonus"), (1, "http://poker-bonus.example.org/free-chips"),
    (1, "https://weight-loss-pills.example.com/miracle"), (1, "http://spam-links.example.net/page1"), (1, "https://click-ads.example.com/track/redirect"),
    (1, "http://discount-pills.example.org/order-now"), (1, "https://generic-viagra.example.com/cheap"), (1, "http://pharma-pills.example.net/no-prescription"),
    (1, "http://casino-slots.example.com/jackpot"), (1, "https://mega-casino.example.org/bonus-codes"), (1, "http://vegas-poker.example.net/casino/roulette"),
    (1, "http://spam-mailer.example.com/bulk"), (1, "https://seo-spam.example.net/backlinks/buy"), (1, "http://farm-links.example.org/spam/2"),
    (1, "https://quick-loans.example.com/payday"), (1, "http://cheap-loans.example.org/instant-credit"), (1, "http://adult-videos.example.org/xxx"),
    (1, "https://porn-tube.example.com/free"), (1, "http://live-sex-cams.example.net/adult"), (1, "https://warez-crack.example.com/keygen"),
    (1, "http://free-download-crack.example.net/serial.exe"), (1, "https://replica-bags.example.org/cheap-luxury"), (1, "http://fake-watches.example.net/replica-sale"),
    (1, "http://login-secure-bank.example.org/verify-account"), (1, "https://paypal-login-update.example.net/password"), (1, "http://win-prize-click.example.com/claim"),
    (1, "https://click-here-win.example.org/free-money"), (1, "http://sports-bet.example.com/win-bonus"), (1, "https://betting-tips.example.net/bet/odds"),
    (1, "http://make-money-quick.example.org/rich"), (1, "https://miracle-diet-pills.example.net/weight-loss"),
    (0, "https://www.library.example.org/catalog/books"), (0, "http://news.city.example.com/politics/elections"), (0, "https://blog.garden.example.net/2023/roses"),
    (0, "http://docs.project.example.org/en/install.html"), (0, "https://www.museum.example.com/visit/hours"), (0, "http://m.weather.example.net/forecast"),
    (0, "https://university.example.edu/courses/history"), (0, "http://www.recipes.example.com/soup/tomato"), (0, "https://forum.bikes.example.net/threads/123"),
    (0, "http://wiki.science.example.org/physics/optics"), (0, "https://www.school.example.com/en/about"), (0, "http://maps.travel.example.net/fr/paris"),
    (0, "https://blog.kitchen.example.com/de/rezepte"), (0, "http://www.health.example.org/advice/sleep"), (0, "https://shop.music.example.net/guitars"),
    (0, "http://journal.law.example.com/articles/88"), (0, "https://www.theatre.example.net/programme"), (0, "http://photos.nature.example.org/birds"),
    (0, "https://help.software.example.com/faq"), (0, "http://www.railways.example.net/timetable"), (0, "https://stories.children.example.com/es/cuentos"),
    (0, "http://radio.local.example.org/schedule"), (0, "https://www.council.example.net/meetings/minutes"), (0, "http://data.open.example.com/datasets/trees"),
    (0, "https://www.news-daily.example.org/politics"), (0, "http://news.region.example.net/articles/55"), (0, "https://blog.travel.example.org/2022/paris"),
    (0, "http://blog.science.example.com/posts/optics"), (0, "https://docs.library.example.net/en/guide.html"), (0, "http://wiki.history.example.com/articles/rome"),
    (0, "https://en.wiki.example.net/physics"), (0, "http://www.city-museum.example.org/visit"), (0, "https://university.example.org/courses/physics"),
    (0, "http://www.college.example.edu/en/history"), (0, "https://forum.gardeners.example.com/threads/9"), (0, "http://forum.software.example.org/topics/linux"),
    (0, "https://www.recipes-home.example.net/soup"), (0, "http://cooking.kitchen.example.org/recipes/bread"), (0, "https://journal.medicine.example.net/articles/12"),
    (0, "http://health.advice.example.com/sleep"), (0, "https://www.weather-city.example.org/forecast"), (0, "http://maps.city.example.com/en/streets"),
    (0, "https://photos.travel.example.net/birds"), (0, "http://www.music-school.example.com/courses"), (0, "https://shop.books.example.org/children"),
    (0, "http://library.school.example.net/catalog"), (0, "https://data.council.example.org/datasets"), (0, "http://www.theatre-city.example.com/programme"),
    (0, "https://radio.news.example.net/schedule"), (0, "http://help.docs.example.com/faq"),
]


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path of a URL."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    ends = [p for p in map(rest.find, "/?#") if p >= 0]
    host = rest[: min(ends, default=len(rest))]
    tail = rest[len(host) :]
    ends = [p for p in map(tail.find, "?#") if p >= 0]
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    return lowered, tail[: min(ends, default=len(tail))]


def places(part: str, text: str) -> list[int]:
    """Hashed n-grams of a part of the URL; ends are marked."""
    marked = f"^{text}$"
    return [zlib.crc32(f"{part}{marked[i : i + n]}".encode("utf-8", "surrogatepass")) % BUCKETS for n in SIZES for i in range(len(marked) - n + 1)]


def features(host: str, path: str) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of a URL's feature vector."""
    where, counts = np.unique(np.array([*places("h", host), *places("p", path)], dtype=np.int64), return_counts=True)
    return where, counts / max(1e-9, np.sqrt((counts**2).sum()))


class UrlModel:
    """A trained logistic regression."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    @classmethod
    def train(cls, labelled: list[tuple[int, str]], steps: int = 400, rate: float = 4.0, ridge: float = 1e-3) -> UrlModel:
        x = np.zeros((len(labelled), BUCKETS))
        for row, (_, url) in enumerate(labelled):
            where, values = features(*split_url(url))
            x[row, where] = values
        y, weights, bias = np.array([float(label) for label, _ in labelled]), np.zeros(BUCKETS), 0.0
        for _ in range(steps):
            error = 1 / (1 + np.exp(-(x @ weights + bias))) - y
            weights -= rate * (x.T @ error / len(y) + ridge * weights)
            bias -= rate * error.mean()
        return cls(weights, float(bias))

    def probability(self, host: str, path: str) -> float:
        where, values = features(host, path)
        return float(1 / (1 + np.exp(-(self.weights[where] @ values + self.bias))))


@lru_cache(maxsize=1)
def default_model() -> UrlModel:
    return UrlModel.train(LABELLED)


def match(host: str, path: str, rules: list[tuple[str, str]]) -> tuple[str | None, str | None]:
    """The longest rule that fits, and its verdict."""
    best: tuple[str | None, str | None] = (None, None)
    for verdict, rule in rules:
        name, slash, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + rest) and len(rule) > len(best[0] or ""):
            best = (rule, verdict)
    return best


def judge(pages: DataFrame, rules: list[tuple[str, str]] | None = None, url: str = "url", threshold: float = 0.5) -> DataFrame:
    """pages with host, path, rule, verdict and block_probability (the method's, also where a rule decides)."""
    rules = RULES if rules is None else rules

    def compute(urls):
        import pyarrow as pa

        model, out = default_model(), []
        for text in urls.to_pylist():
            host, path = split_url(text)
            rule, verdict = match(host, path, rules)
            p = model.probability(host, path)
            out.append((host, path, rule, verdict or ("block" if p >= threshold else "allow"), p))
        columns = list(zip(*out, strict=True)) or [()] * 5
        return [pa.array(list(c), t) for c, t in zip(columns, [pa.string()] * 4 + [pa.float64()], strict=True)]

    return append_columns(pages, [url], "host string, path string, rule string, verdict string, block_probability double", compute)


