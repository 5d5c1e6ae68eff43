"""ludeme.plans"""
