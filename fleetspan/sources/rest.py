"""The position API as a batch source: ``spark.dataSource.register(PositionApi)``, then ``spark.read.format("position_api")``."""

from __future__ import annotations

import json
import urllib.parse
import urllib.request
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader

# Names and paths of the public API.
ENDPOINTS = {
    "positions": "/Posicao", "line_positions": "/Posicao/Linha", "lines": "/Linha/Buscar", "line": "/Linha/CarregarLinha", "stops": "/Parada/Buscar", "stops_of_line": "/Parada/BuscarParadasPorLinha",
    "corridors": "/Corredor", "forecast_line": "/Previsao/Linha", "forecast_stop": "/Previsao/Parada", "forecast": "/Previsao",
}


class PositionApi(DataSource):
    """Options: ``url``, ``token``, ``endpoint`` (a name of ENDPOINTS), ``query`` (URL-encoded), or ``file`` with a stored response for offline use."""

    @classmethod
    def name(cls) -> str:
        return "position_api"

    def schema(self) -> str:
        return "endpoint string, response_status int, raw_json string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = options

    def read(self, partition) -> Iterator[tuple]:
        name = self.options.get("endpoint", "positions")
        if name not in ENDPOINTS:
            raise ValueError(f"unknown endpoint: {name}")
        if "file" in self.options:
            with open(self.options["file"], encoding="utf-8") as f:
                yield ENDPOINTS[name], 200, f.read()
            return
        base = self.options["url"].rstrip("/")
        opener = urllib.request.build_opener(urllib.request.HTTPCookieProcessor())
        opener.open(f"{base}/Login/Autenticar?" + urllib.parse.urlencode({"token": self.options.get("token", "")}), data=b"", timeout=30).read()
        with opener.open(base + ENDPOINTS[name] + (f"?{self.options['query']}" if self.options.get("query") else ""), timeout=60) as answer:
            yield ENDPOINTS[name], answer.status, answer.read().decode("utf-8", "replace")


def is_json(text: str) -> bool:
    try:
        json.loads(text)
    except ValueError:
        return False
    return True
