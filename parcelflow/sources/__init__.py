"""Sources and sinks: fixtures adapter, bronze layout, safe upsert,
cold archive, publish."""
