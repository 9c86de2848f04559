"""Sources and sinks at the edge: driver tables, the JSON message topic
(Kafka or files), and the fixture mapping from tables to events."""
