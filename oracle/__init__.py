"""The same queries in DuckDB SQL, for checking results. Not used by the library."""

from oracle import growth, ingest, people, serving

ORACLES: dict[str, str] = {
    **growth.ORACLES,
    **ingest.ORACLES,
    **serving.ORACLES,
    **people.ORACLES,
}
