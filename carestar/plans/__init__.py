"""carestar.plans"""
