"""Column functions; all of them stay inside the JVM but the blocked scoring of ``blocks``."""
