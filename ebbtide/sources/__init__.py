"""Landing files, stored tables and the shared work folder."""
