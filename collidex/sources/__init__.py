"""Sources and sinks: nested event scans, the lineitem-derived fixture,
feature/sequence/image tables and the scaling log."""
