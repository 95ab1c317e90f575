"""Native column expressions; nothing here leaves the JVM."""
