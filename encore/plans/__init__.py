"""The warehouse jobs as DataFrame -> DataFrame functions (``jobs`` wires them to tables)."""
